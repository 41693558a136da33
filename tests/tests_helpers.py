SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def nan_rows():
    nan = float("nan")
    return [(i, 1000 * i, "d", nan if i % 3 == 0 else 4.0 + i, 50.0, False, 100.0, False, 3.0,
             21.0, False, False) for i in range(30)]
