"""Reading documents, statements, manifests, gold and predictions as DataFrames."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

TEXT_NAMES = ("text", "content", "markdown", "full_text", "body")
ID_NAMES = ("id", "doc_id", "document_id", "doi", "file_name", "filename")
MANIFEST = "input_file string, year int, size_bytes bigint, est_seconds double, status string, job_id string, attempts int, rows bigint, elapsed_s double, started_at string, finished_at string, error string"

#: Rows in one range of :func:`with_position`, about, and ranges at most.
RANGE_ROWS, MOST_RANGES = 200_000, 256


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at))


def _no_hidden(path: Column, root: str) -> Column:
    """No folder or file below ``root`` begins with a dot or an underscore."""
    inside = F.substring_index(path, root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    return ~F.exists(F.split(inside, "/"), lambda p: p.startswith(".") | p.startswith("_"))


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet", missing_ok: bool = False) -> DataFrame:
    """(path, size_bytes) of the files below ``root``, sorted by path, hidden ones left out; contents are not read.

    A missing folder is an error, or gives no rows with ``missing_ok``.
    """
    if not exists(spark, root):
        if missing_ok:
            return spark.createDataFrame([], "path string, size_bytes bigint")
        raise FileNotFoundError(root)
    got = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return got.select("path", F.col("length").alias("size_bytes")).filter(_no_hidden(F.col("path"), root)).orderBy("path")


def input_format(path: str, names: Sequence[str], requested: str | None = None) -> str:
    """'markdown' or 'parquet': what was requested, else by the file's suffix, else by what the folder has, Markdown first."""
    if requested and requested != "auto":
        return requested
    for end, kind in ((".md", "markdown"), (".parquet", "parquet")):
        if path.lower().endswith(end):
            return kind
    kinds = {os.path.splitext(n)[1].lower() for n in names}
    return "markdown" if ".md" in kinds or ".parquet" not in kinds else "parquet"


def markdown_documents(spark: SparkSession, root: str) -> DataFrame:
    """(document_id, checkpoint_key, content) of every ``*.md`` file; the id is the base name, the key the full path.

    ``root`` may be one file; a missing path or another kind of file is an error.
    """
    if not exists(spark, root):
        raise FileNotFoundError(root)
    reader = spark.read.option("wholetext", True)
    if not root.lower().endswith(".md"):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md")
    got = reader.text(root).select("*", F.col("_metadata.file_path").alias("path"))
    rows = got.select(F.element_at(F.split("path", "/"), -1).alias("document_id"), F.col("path").alias("checkpoint_key"), F.col("value").alias("content"))
    return rows.filter(_no_hidden(F.col("checkpoint_key"), root))


def resolve_column(columns: Sequence[str], requested: str | None, candidates: Sequence[str]) -> tuple[str, bool]:
    """(name, inferred): the requested column, whatever its case, else the first candidate there is; an error where none is."""
    low = {}
    for c in columns:
        low.setdefault(c.lower(), c)
    if requested:
        if requested.lower() not in low:
            raise ValueError(f"no column {requested} among {', '.join(columns)}")
        return low[requested.lower()], False
    for c in candidates:
        if c.lower() in low:
            return low[c.lower()], True
    raise ValueError(f"none of {', '.join(candidates)} among {', '.join(columns)}")


def parquet_documents(spark: SparkSession, path: str, text_col: str | None = None, id_col: str | None = None) -> DataFrame:
    """(document_id, checkpoint_key, content) of the rows whose text is not blank.

    Texts are stripped, binary ones decoded.  Where there is no id (no such column, NULL or empty) it is
    ``<file stem>-row-<n>``, n counting all rows of the file; the key adds the file's path.
    """
    rows = spark.read.parquet(path)
    text, _ = resolve_column(rows.columns, text_col, TEXT_NAMES)
    try:
        named = F.col(resolve_column(rows.columns, id_col, ID_NAMES)[0]).cast("string")
    except ValueError:
        if id_col:
            raise
        named = F.lit(None).cast("string")
    value = F.decode(F.col(text), "UTF-8") if dict(rows.dtypes)[text] == "binary" else F.col(text).cast("string")
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.parquet$", "")
    made = F.coalesce(F.nullif(named, F.lit("")), F.concat(stem, F.lit("-row-"), F.col("_metadata.row_index")))
    out = rows.select(made.alias("document_id"), F.concat_ws("::", F.col("_metadata.file_path"), made).alias("checkpoint_key"), T.strip(value).alias("content"))
    return out.filter(F.col("content") != "")


def load_text(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (content, file_path) with ``text``: the content, else the text of the file (``files``: checkpoint_key, content)."""
    other = files.select(F.col("checkpoint_key").alias("__path"), F.col("content").alias("__read"))
    return rows.join(other, F.col("file_path") == F.col("__path"), "left").withColumn("text", F.coalesce("content", "__read")).drop("__path", "__read")


def usable_rows(rows: DataFrame, text: str = "text", status: str = "status", ident: str = "id") -> DataFrame:
    """``rows`` whose status is 'ok' and whose text is not empty (blanks count as text), with ``doc_key``, the id or the row's number where it is NULL, empty or 0."""
    falsy = F.col(ident).isNull() | F.col(ident).cast("string").isin("", "0")
    numbered = rows.withColumn("doc_key", F.when(falsy, F.monotonically_increasing_id().cast("string")).otherwise(F.col(ident).cast("string")))
    return numbered.filter((F.col(status) == "ok") & (F.coalesce(F.col(text), F.lit("")) != ""))


def skip_counts(rows: DataFrame, text: str = "text", status: str = "status") -> DataFrame:
    """(seen, not_ok, empty): what :func:`usable_rows` leaves out."""
    ok = F.coalesce(F.col(status) == "ok", F.lit(False))
    return rows.agg(F.count("*").alias("seen"), F.count_if(~ok).alias("not_ok"), F.count_if(ok & (F.coalesce(F.col(text), F.lit("")) == "")).alias("empty"))


def merged_split(spark: SparkSession, root: str, folders: Sequence[str], split: str) -> DataFrame:
    """All rows of ``<folder>/<split>.jsonl``; columns that a file lacks are NULL."""
    out = None
    for f in folders:
        one = spark.read.json(f"{root}/{f}/{split}.jsonl")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def contiguous_shard(rows: DataFrame, order: Sequence[str | Column], shard: int, shards: int, most: int | None = None) -> DataFrame:
    """Rows of one of ``shards`` contiguous ranges in ``order`` of the first ``most``; ranges hold ceil(n / shards) rows.

    Positions come from ranges of values that are counted: no window over all rows.
    """
    capped = rows.orderBy(*order).limit(most) if most is not None else rows
    n = capped.count()
    size = -(-n // shards) if n else 0
    return with_position(capped, order).filter((F.col("position") >= shard * size) & (F.col("position") < (shard + 1) * size)).drop("position")


def with_position(rows: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``rows`` with their position, from 0, in the ascending ``order`` (names or expressions).

    Rows are dealt to ranges by their values alone: bounds come from a sample and are literals of the plan.  So the counts
    of the ranges, of which only these go to the driver, hold for every later run of the plan, whereas Spark's own range
    partitions are sampled anew each time.  Ranges are numbered each on its own.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.withColumn("__key", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    n = keyed.count()
    ranges = min(MOST_RANGES, -(-n // RANGE_ROWS))
    bound, offset = [], {0: 0}
    if ranges > 1:
        drawn = keyed.sample(min(1.0, 200 * ranges / n), 7).select("__key").distinct().orderBy("__key").collect()
        bound = [drawn[len(drawn) * i // ranges]["__key"] for i in range(1, ranges) if drawn]
    if bound:
        types = [f.dataType for f in keyed.schema["__key"].dataType]
        one = lambda b: F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, types))])
        keyed = keyed.withColumn("__range", F.size(F.filter(F.array(*map(one, bound)), lambda b: b <= F.col("__key"))))
        seen = 0
        for r in sorted(keyed.groupBy("__range").count().collect()):
            offset[r["__range"]], seen = seen, seen + r["count"]
    else:
        keyed = keyed.withColumn("__range", F.lit(0))
    before = F.try_element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in (kv[0], int(kv[1]))]).cast("map<int,bigint>"), F.col("__range"))
    local = F.row_number().over(Window.partitionBy("__range").orderBy("__key")) - 1
    return keyed.withColumn(name, before + local).drop("__key", "__range")


def benchmark_sample(rows: DataFrame, order: Sequence[str | Column], augmented: Column | None = None, most: int | None = None, shard: int = 0, shards: int = 1) -> DataFrame:
    """Rows that are not augmented, the first ``most`` in ``order``, one contiguous shard of them."""
    return contiguous_shard(rows if augmented is None else rows.filter(~augmented), order, shard, shards, most)


def with_statements(rows: DataFrame, column: str = "predicted_statements") -> DataFrame:
    """Rows whose list is neither NULL nor empty."""
    return rows.filter(F.size(F.coalesce(F.col(column), F.array())) > 0)


def processed_keys(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Distinct composite keys of an earlier output; none where there is no output."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{k} string" for k in keys))
    return spark.read.parquet(path).select(*keys).distinct()


def matching_rows(spark: SparkSession, paths: Sequence[str] | str, mask: Column) -> DataFrame:
    """Rows of many prediction files under one schema, types promoted, that the mask keeps."""
    got = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    return got.filter(mask)


def funded(statements: str = "predicted_statements", most: int = 8000) -> Column:
    """A list of statements that is not empty and has ``most`` characters at most in all."""
    total = F.aggregate(F.transform(F.col(statements), F.length), F.lit(0), lambda a, n: a + n)
    return (F.size(F.coalesce(F.col(statements), F.array())) > 0) & (total <= most)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows by the files' footers."""
    return spark.read.parquet(path).count()


def gold_statements(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, statements) of a JSON array of objects."""
    return spark.read.option("multiLine", True).json(path)


def predicted_statements(spark: SparkSession, path: str, key: str = "results") -> DataFrame:
    """(file_name, statement) of a JSON map from file names to results; items may be objects or strings, objects without text are dropped."""
    raw = spark.read.option("wholetext", True).text(path)
    results = F.from_json(F.coalesce(F.get_json_object("value", f"$.{key}"), F.col("value")), "map<string,string>")
    each = raw.select(F.explode(results).alias("file_name", "doc"))
    items = F.coalesce(F.get_json_object("doc", "$.funding_statements"), F.col("doc"))
    one = each.select("file_name", F.explode(F.from_json(items, "array<string>")).alias("item"))
    text = F.when(F.col("item").startswith("{"), F.get_json_object("item", "$.statement")).otherwise(F.col("item"))
    return one.select("file_name", text.alias("statement")).filter(F.coalesce(F.col("statement"), F.lit("")) != "")


def gold_lookup(rows: DataFrame, key: str = "funding_statement", order: Sequence[str | Column] = ("line",), last: bool = False) -> DataFrame:
    """One row for each key, the first in ``order`` or the last, with ``duplicates``, how many others there were."""
    w = Window.partitionBy(key)
    by = [F.desc(c) if last and isinstance(c, str) else c for c in order]
    numbered = rows.withColumns({"__rn": F.row_number().over(w.orderBy(*by)), "duplicates": F.count("*").over(w) - 1})
    return numbered.filter("__rn = 1").drop("__rn")


def predictions_of(rows: DataFrame) -> DataFrame:
    """``rows`` with ``predicted_funders``, from ``funders`` where only that is there or the other is NULL."""
    names = {c.lower() for c in rows.columns}
    parts = [F.col(c) for c in ("predicted_funders", "funders") if c in names]
    if not parts:
        raise ValueError("neither predicted_funders nor funders is there")
    return rows.withColumn("predicted_funders", F.coalesce(*parts))


def rollouts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doi, prediction), (line, doi, error)) of chat rows (line, doi, messages ARRAY<STRUCT<role, content>>).

    The first message of the assistant counts; the last line of a DOI that parses wins; rows without a DOI are passed over.
    """
    said = F.filter("messages", lambda m: m["role"] == "assistant")
    one = rows.filter(F.coalesce(F.col("doi"), F.lit("")) != "").select("line", "doi", F.get(said, F.lit(0))["content"].alias("said"))
    parsed = one.withColumn("ok", F.try_parse_json("said").isNotNull())
    good = parsed.filter("ok").groupBy("doi").agg(F.max_by("said", "line").alias("prediction"))
    bad = parsed.filter(~F.col("ok")).select("line", "doi", F.when(F.col("said").isNull(), "No assistant message").otherwise("JSON parse error").alias("error"))
    return good, bad


def healing_rows(spark: SparkSession, path: str, content_col: str | None = None, name_col: str | None = None) -> DataFrame:
    """(name, content) of a Parquet table of texts; names are made from row numbers where no column has them."""
    rows = spark.read.parquet(path)
    content, _ = resolve_column(rows.columns, content_col, TEXT_NAMES)
    try:
        name = F.col(resolve_column(rows.columns, name_col, ("file_name", "filename", "name", "path", "id"))[0]).cast("string")
    except ValueError:
        name = F.concat(F.lit("row_"), F.col("_metadata.row_index"), F.lit(".md"))
    return rows.select(name.alias("name"), F.col(content).cast("string").alias("content"))


def by_id(rows: DataFrame, key: str) -> DataFrame:
    """(key, rows) of all rows with a key, in no order; for keys of few rows each, as training examples of one document."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*[c for c in rows.columns if c != key])).alias("rows"))


def existing_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Earlier results, or none where they are missing or can't be read."""
    try:
        got = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        got.limit(1).collect()
        return got
    except Exception:  # an unreadable file of a broken run is no reason to stop the next
        return spark.createDataFrame([], schema)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their keys: the same each time, however the rows are divided."""
    return rows.withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).orderBy("__h", key).limit(n).drop("__h")
