"""Comparison of a Spark result with a DuckDB relation."""


def same_rows(spark_df, duck_rel) -> None:
    """Equal columns and equal rows as multisets, floats rounded."""
    columns = sorted(spark_df.columns)
    assert columns == sorted(duck_rel.columns)
    plain = lambda row: tuple(round(x, 6) if isinstance(x, float) else x for x in row)
    got = sorted((plain(r) for r in spark_df.select(*columns).collect()), key=repr)
    want = sorted((plain(r) for r in duck_rel.select(*columns).fetchall()), key=repr)
    assert got == want
