from pyspark.sql import functions as F


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def apply(spark, values, fn, kinds="string"):
    """fn(columns...) for each tuple of values, in order."""
    width = len(values[0])
    kinds = [kinds] * width if isinstance(kinds, str) else kinds
    schema = "i int, " + ", ".join(f"c{n} {k}" for n, k in enumerate(kinds))
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)
    out = df.select("i", fn(*[F.col(f"c{n}") for n in range(width)]).alias("out"))
    return [r.out for r in out.orderBy("i").collect()]
