"""Writers to a database table over JDBC."""

import uuid

from ..operators.zones import flatten_window


def jdbc_append(url, table, properties, save=None):
    """`foreachBatch` writer that appends each batch.

    For queries in append mode only: in update mode a window is emitted again, which a
    keyed table refuses. Errors leave the function, so the engine runs the batch again.
    """
    def write_batch(batch_df, batch_id):
        rows = (flatten_window(batch_df, batch_id) if "window" in batch_df.columns else batch_df).persist()
        try:
            if not rows.isEmpty():
                (save or _append)(rows, url, table, properties)
        finally:
            rows.unpersist()
    return write_batch


def _append(rows, url, table, properties):
    rows.write.jdbc(url, table, mode="append", properties=properties)


def merge_statement(table, staging, keys, columns):
    """One statement that brings `staging` into `table`, newest values winning."""
    rest = [c for c in columns if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    values = ", ".join(f"{c} = s.{c}" for c in rest)
    return (
        f"MERGE INTO {table} AS t USING {staging} AS s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {values} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join('s.' + c for c in columns)})"
    )


def jdbc_upsert(url, table, properties, keys, save=None, run_statement=None):
    """`foreachBatch` writer that replaces rows by key: executors fill a staging table in
    parallel, then one MERGE inside the database applies it, and the staging table is
    dropped. Its name is new in every call, so writers of one table do not meet in it."""
    def write_batch(batch_df, batch_id):
        rows = (flatten_window(batch_df, batch_id) if "window" in batch_df.columns else batch_df).persist()
        try:
            if rows.isEmpty():
                return
            staging = f"{table}_staging_{batch_id}_{uuid.uuid4().hex[:12]}"
            run = run_statement or _run
            try:
                (save or _replace)(rows, url, staging, properties)
                run(rows.sparkSession, url, properties, merge_statement(table, staging, list(keys), rows.columns))
            finally:
                run(rows.sparkSession, url, properties, f"DROP TABLE IF EXISTS {staging}")
        finally:
            rows.unpersist()
    return write_batch


def _replace(rows, url, table, properties):
    rows.write.jdbc(url, table, mode="overwrite", properties={**properties, "truncate": "true"})


def _run(spark, url, properties, statement):
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    if "driver" in properties:  # brought by spark.jars.packages, it is known to Spark's class loader only
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = loader.loadClass(properties["driver"]).getDeclaredConstructor(
            spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)).newInstance(
            spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0))
        connection = driver.connect(url, settings)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()
