"""Catalog tables, JSON files and named SQL (SRC6, SRC7, SRC8).

A *named SQL catalogue* maps a name to SQL text; running a name is
``spark.sql(text)`` after the tables it reads are registered, so Catalyst
plans it like any other query.  Catalogues can be loaded from a Java-style
``.properties`` file (``name=text``, lines continued with a trailing
backslash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Our own named queries; ``{views}`` stands for the DataFrame given under that name.
NAMED_SQL: dict[str, str] = {
    "views_per_day": """
        SELECT bdp_day, count(*) AS view_count, count(DISTINCT user_id) AS user_count
        FROM {views} GROUP BY bdp_day""",
}


def load_properties(text: str) -> dict[str, str]:
    """Parse ``.properties`` text: ``key=value`` or ``key: value``, ``#``/``!``
    comments, a trailing backslash continues the value on the next line."""
    out: dict[str, str] = {}
    key, buf = None, []
    for raw in text.splitlines():
        line = raw.strip()
        if key is None:
            if not line or line[0] in "#!":
                continue
            sep = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=-1)
            if sep < 0:
                continue
            key, rest = line[:sep].strip(), line[sep + 1:].strip()
            buf = []
        else:
            rest = line
        if rest.endswith("\\"):
            buf.append(rest[:-1])
            continue
        buf.append(rest)
        out[key] = " ".join(b.strip() for b in buf if b.strip())
        key = None
    if key is not None:
        out[key] = " ".join(b.strip() for b in buf if b.strip())
    return out


def load_sql_catalogue(spark: SparkSession, path: str) -> dict[str, str]:
    """Read a ``.properties`` catalogue of named SQL from any Spark path.
    The file is small configuration; it is read as one whole-text record."""
    rows = spark.read.text(path, wholetext=True).collect()
    return {k: v for r in rows for k, v in load_properties(r[0]).items()}


def run_named(spark: SparkSession, name: str, catalogue: dict[str, str] | None = None,
              views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run catalogue entry ``name`` (default catalogue: :data:`NAMED_SQL`);
    ``views`` gives the DataFrames that the text names in braces.  No view is
    registered in the session."""
    cat = NAMED_SQL if catalogue is None else catalogue
    return spark.sql(cat[name], **(views or {}))


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """SRC7: catalog table scan (column pruning and partition filters are
    pushed down by the planner)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save ``df`` as a table in ``buckets`` files sorted by ``key``, with statistics.  Tables
    saved with the same number of buckets join on their keys without a shuffle."""
    w = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {key}")


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC6: JSON lines file.  Without ``schema`` Spark infers it with an
    extra pass over the input; pass one for large inputs."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)
