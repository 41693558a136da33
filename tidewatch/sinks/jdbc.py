"""JDBC sinks that a replayed batch leaves as they were (K1, K2 on a database).

A batch goes to a staging table of its own first, written by Spark's JDBC
writer from the executors; a run that died half-way is replaced there. One
transaction then puts it in the place of whatever the target holds of that
batch. So a replay changes nothing, also where it yields other rows than the
first time (the limits may have changed in between), and readers see a batch
whole or not at all. The target has the columns of the output and a column
``batch_id`` (an index on it keeps the replacement cheap).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")
# Options of Spark's writer that are not for the driver's own connection.
_WRITER_ONLY = {"url", "dbtable", "driver", "batchsize", "numpartitions", "isolationlevel", "truncate",
                "createtableoptions", "createtablecolumntypes"}


def staging_table(target: str, batch_id: int) -> str:
    """The name of a batch's staging table, beside the target."""
    if not _NAME.fullmatch(target):
        raise ValueError(f"not a table name: {target!r}")
    if int(batch_id) < 0:
        raise ValueError(f"a batch id is not negative: {batch_id}")
    return f"{target}_stage_{int(batch_id)}"


def replace_statements(target: str, columns: list[str], batch_id: int, quote: str = '"') -> list[str]:
    """The statements of the transaction that puts a staged batch in the place
    of what the target holds of it. Dropping the staging table comes last:
    where that commits on its own, the rows before it are complete."""
    stage = staging_table(target, batch_id)
    names = ", ".join(quote + c.replace(quote, quote * 2) + quote for c in [*columns, "batch_id"])
    batch = f"{quote}batch_id{quote}"
    return [f"DELETE FROM {target} WHERE {batch} = {int(batch_id)}",
            f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage}",
            f"DROP TABLE {stage}"]


def connect(spark: SparkSession, url: str, driver: str | None = None, **properties):
    """A ``java.sql.Connection`` of the Spark driver."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for key, value in properties.items():
        if key.lower() not in _WRITER_ONLY:
            props.setProperty(key, str(value))
    if driver is None:
        return jvm.java.sql.DriverManager.getConnection(url, props)
    # jars given to Spark are seen by the thread's loader, not by DriverManager
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.loadClass(driver).newInstance().connect(url, props)


def in_one_transaction(connection, statements: list[str]) -> None:
    """All statements or none; the connection is closed either way."""
    try:
        connection.setAutoCommit(False)
        try:
            for sql in statements:
                statement = connection.createStatement()
                try:
                    statement.executeUpdate(sql)
                finally:
                    statement.close()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def stage(df: DataFrame, table: str, options: dict) -> None:
    """Write ``df`` as the whole of ``table``, replacing an earlier attempt."""
    df.write.format("jdbc").options(**{**options, "dbtable": table}).mode("overwrite").save()


def replace_batch(df: DataFrame, batch_id: int, options: dict, quote: str = '"',
                  connect: Callable = connect, stage: Callable = stage) -> None:
    """Make the rows of ``df`` those of batch ``batch_id`` in the table
    ``options["dbtable"]``. ``options`` are those of Spark's JDBC writer; the
    ones it does not use itself (user, password, ...) also open the connection
    of the transaction. An empty batch empties the target of that batch."""
    missing = [k for k in ("url", "dbtable") if not options.get(k)]
    if missing:
        raise ValueError(f"a JDBC sink needs the options {', '.join(missing)}")
    if "batch_id" in df.columns:
        raise ValueError("the column batch_id is the sink's own")
    target = options["dbtable"]
    stage(df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")), staging_table(target, batch_id), options)
    in_one_transaction(connect(df.sparkSession, **options), replace_statements(target, df.columns, batch_id, quote))
