"""Flat batch tables (one profile per indented line) and the label arrays that answer them."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.functions.text import table_cell, trim_all
from kithscope.operators.ordering import number_in_blocks
from kithscope.schemas import LABEL_ITEMS_DDL
from kithscope.session import remove

COLUMNS = ["handle", "name", "bio", "category", "followers"]
HEADER = r"\[(\d+)\]\{[^}]*\}:\s*$"


def _cell(name: str) -> Column:
    """A cell keeps its spelling except the literal ``null``, which means missing."""
    value = trim_all(F.col(f"row.{name}"))
    return F.when(value != "null", value)


def read_batches(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Profiles of ``batch-NN`` files. Padding around cells is cut; quotes are doubled inside quotes."""
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), trim_all(F.col("value")).alias("line")
    )
    body = lines.filter((F.col("line") != "") & ~F.col("line").rlike(HEADER))
    ddl = ", ".join(f"{name} string" for name in COLUMNS)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"}
    parsed = body.withColumn("row", F.from_csv("line", ddl, options))
    return parsed.select(
        F.regexp_extract("file", r"batch[-=](\d+)", 1).try_cast("bigint").alias("batch_no"),
        trim_all(F.col("row.handle")).alias("handle"),
        trim_all(F.col("row.name")).alias("name"),
        trim_all(F.col("row.bio")).alias("bio"),
        _cell("category").alias("category"),
        F.coalesce(F.regexp_extract(F.col("row.followers"), r"\d+", 0).try_cast("bigint"), F.lit(0)).alias("followers"),
    ).filter(F.col("handle").isNotNull())


TABLE_HEAD = r"^\s*\w*\[(\d+)\]\{([^}]*)\}:\s*$"
PLAIN_HEAD = r"^\s*handle\s*[,\t]"
MOST_COLUMNS = 16


def _facts(lines: DataFrame) -> DataFrame:
    """One row per file: its columns, separator, declared and found rows, and why it cannot be trusted, if so."""
    counted, plain = F.col("line").rlike(TABLE_HEAD), F.col("line").rlike(PLAIN_HEAD)
    head = counted | plain
    tabs = F.length("line") - F.length(F.replace("line", F.lit("\t"), F.lit("")))
    facts = lines.groupBy("file").agg(
        F.count(F.when(head, 1)).alias("heads"),
        F.max(F.when(counted, F.regexp_extract("line", TABLE_HEAD, 1).try_cast("bigint"))).alias("declared"),
        F.max(F.when(counted, F.regexp_extract("line", TABLE_HEAD, 2)).when(plain, F.col("line"))).alias("columns"),
        F.count(F.when(~head, 1)).alias("found"),
        F.min(F.when(~head, tabs)).alias("tabs"),
    )
    columns = F.transform(F.split("columns", "[,\t]"), trim_all)
    facts = facts.withColumn("columns", columns)
    # A header may list its columns with commas over rows that tabs divide: the rows decide.
    sep = F.when(F.col("tabs") >= F.size("columns") - 1, "\t").otherwise(",")
    reason = (
        F.when(F.col("heads") == 0, "no header")
        .when(F.col("heads") > 1, "several headers")
        .when(~F.array_contains("columns", "handle") | (F.size("columns") > MOST_COLUMNS), "other columns")
        .when(F.col("declared") != F.col("found"), "row count")
    )
    return facts.select("file", "columns", sep.alias("sep"), "declared", "found", reason.alias("reason"))


def _numbered_file(file: Column) -> Column:
    return F.regexp_extract(file, r"batch[-=](\d+)", 1).try_cast("bigint")


def read_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Profiles of all table files below ``path``, each in its own dialect, and the files that were refused.

    A file has a header ``name[N]{columns}:`` or one of column names alone; rows are divided by commas (padded or not) or by tabs. Both
    are found per file, combined map-side; a file with no header, two of them, unknown columns or another number of
    rows than it declares is refused as a whole.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r$", "").alias("line"))
    lines = lines.filter(trim_all(F.col("line")) != "")
    facts = _facts(lines)
    refused = facts.filter("reason is not null").select(_numbered_file(F.col("file")).alias("batch_no"), "file", "declared", "found", "reason")
    good = facts.filter("reason is null").select("file", "columns", "sep")
    body = lines.filter(~F.col("line").rlike(TABLE_HEAD) & ~F.col("line").rlike(PLAIN_HEAD)).join(good, "file")
    ddl = ", ".join(f"c{i} string" for i in range(MOST_COLUMNS))
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    bare = F.ltrim("line")
    by = lambda sep: F.from_csv(bare, ddl, {"sep": sep, **options})
    row = F.when(F.col("sep") == "\t", by("\t")).otherwise(by(","))
    cells = body.withColumn("row", row).withColumn("cells", F.array(*[F.col(f"row.c{i}") for i in range(MOST_COLUMNS)]))
    cell = lambda name: F.coalesce(trim_all(F.try_element_at("cells", F.nullif(F.array_position("columns", name), F.lit(0)).cast("int"))), F.lit(""))
    rows = cells.select(
        _numbered_file(F.col("file")).alias("batch_no"), cell("handle").alias("handle"), cell("name").alias("name"), cell("bio").alias("bio"),
        F.when(cell("category") != "null", cell("category")).alias("category"),
        F.coalesce(F.regexp_extract(cell("followers"), r"^\d+", 0).try_cast("bigint"), F.lit(0)).alias("followers"),
    ).filter("handle <> ''")
    return rows, refused


def batch_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Row count each file declares in its header against the rows it holds."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), trim_all(F.col("value")).alias("line"))
    is_header = F.col("line").rlike(HEADER)
    declared = F.max(F.when(is_header, F.regexp_extract("line", HEADER, 1).try_cast("bigint")))
    found = F.count(F.when(~is_header & (F.col("line") != ""), 1))
    return lines.groupBy("file").agg(declared.alias("declared"), found.alias("found"))


def read_label_arrays(spark: SparkSession, path: str, *folders: str) -> DataFrame:
    """Label files ``haiku-NN.json`` or ``haiku.NN.json``, or folders ``batch=NN``; empty, invalid or non-array files give no rows.

    ``pos`` is the place in the array, so that the last of several labels for one handle can win. Columns that
    stand in names of ``folders`` (``scored_by=...``) are kept.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"(?:[-.](?=\d+\.json)|batch=)(\d+)", 1).try_cast("bigint").alias("batch_no"),
        *folders,
        F.from_json(trim_all(F.col("value")), LABEL_ITEMS_DDL).alias("items"),
    )
    rows = files.filter(F.col("items").isNotNull()).select("batch_no", *folders, F.posexplode("items").alias("pos", "item"))
    return rows.select("batch_no", *folders, "pos", "item.handle", "item.label", "item.reason")


def profile_line(indent: str = "  ", sep: str = ",") -> Column:
    cells = [table_cell(F.coalesce(F.col(c), F.lit(""))) for c in ("handle", "name", "bio")]
    category = F.coalesce(table_cell(F.col("category")), F.lit("null"))
    return F.concat(F.lit(indent), F.concat_ws(sep, *cells, category, F.col("followers").cast("string")))


def header_line(count: Column, name: str = "", columns: str = "handle,name,bio,category,followers") -> Column:
    return F.concat(F.lit(f"{name}["), count.cast("string"), F.lit(f"]{{{columns}}}:"))


def batch_text(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One text block per batch. A batch holds at most its fixed size, so collecting it is bounded."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), profile_line().alias("line"))))
    return df.groupBy(*keys).agg(rows.alias("rows")).select(
        *keys, F.size("rows").cast("bigint").alias("size"),
        F.concat_ws("\n", header_line(F.size("rows")), F.transform("rows", lambda r: r["line"])).alias("text"),
    )


def label_json(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Label array per batch, in the order of the batch."""
    item = F.struct("handle", "label", "reason")
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("item"))))
    items = F.transform("rows", lambda r: r["item"])
    packed = F.to_json(items, {"ignoreNullFields": "false"})
    return df.groupBy(*keys).agg(rows.alias("rows")).select(*keys, packed.alias("text"))


BATCHES_PER_FOLDER = 32
# A local file system starts a process for the rights of every new folder, file and checksum file, which takes longer than a small text does.
# Its plain form keeps no checksum files; other stores are not concerned.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def by_folder(df: DataFrame, key: str = "batch") -> DataFrame:
    """Rows with the ``folder`` that their batch is written below, those of one folder in one task.

    When a write ends, the driver moves a folder of one task as a whole, one of several tasks file by file. Readers list as many
    folders at a time as there are tasks. Grouped by folder and batch, the rows do not move again. The number of tasks is given, since
    the time goes by files, and by their bytes Spark would put them all into few.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("folder", F.floor(F.col(key) / BATCHES_PER_FOLDER)).repartition(tasks, "folder")


def write_batches(texts: DataFrame, path: str, *keys: str) -> None:
    """One file per batch number, or per values of other ``keys``, written in parallel; texts of :func:`by_folder` rows go below their folders."""
    keys = keys or ("batch",)
    folders = [c for c in texts.columns if c == "folder"] + list(keys)
    writer = texts.select(*folders, F.col("text").alias("value")).write.mode("errorifexists").options(**SMALL_FILES)
    writer.partitionBy(*folders).text(path)


def write_batch_lines(texts: DataFrame, path: str) -> None:
    """All batches as JSON lines, many to a file: a folder for each would be far too many for a large set."""
    texts.write.mode("errorifexists").json(path)


def read_batch_lines(spark: SparkSession, path: str) -> DataFrame:
    """Profiles of such files with the place of each in its batch."""
    texts = spark.read.schema("batch bigint, size bigint, text string").json(path)
    lines = texts.select(F.col("batch").alias("batch_no"), F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("pos > 0")
    ddl = ", ".join(f"{name} string" for name in COLUMNS)
    row = F.from_csv(F.ltrim("line"), ddl, {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"})
    cells = lines.withColumn("row", row)
    text = lambda name: F.coalesce(trim_all(F.col(f"row.{name}")), F.lit(""))
    return cells.select(
        "batch_no", (F.col("pos") - 1).cast("bigint").alias("position"), text("handle").alias("handle"), text("name").alias("name"), text("bio").alias("bio"),
        _cell("category").alias("category"), F.col("row.followers").try_cast("bigint").alias("followers"),
    )


LINES_PER_TASK = 50_000


def profile_set_lines(df: DataFrame, keyword: Column) -> DataFrame:
    """Lines of an unlimited profile set, most followers first, to be written per keyword: one keyword per row of ``df``."""
    return shared_set_lines(df, F.array(keyword))


def shared_set_lines(df: DataFrame, keywords: Column) -> DataFrame:
    """The same for rows that each stand in the sets of all their ``keywords``: the text of a row is kept once.

    The set is not collected: the writer range-sorts the lines and the header is its own small row.
    """
    body = df.select(
        keywords.alias("keywords"), F.lit(1).alias("part"), F.col("followers").alias("followers"),
        F.col("handle"), profile_line().alias("value"),
    )
    heads = df.select(F.explode(keywords).alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).select(
        F.array("keyword").alias("keywords"), F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("followers"),
        F.lit(None).cast("string").alias("handle"), header_line(F.col("n")).alias("value"),
    )
    return heads.unionByName(body)


def write_profile_sets(lines: DataFrame, path: str, compression: str = "none", lines_per_task: int = LINES_PER_TASK) -> None:
    """One folder per keyword. Rows are dealt by their order, whatever their keywords, and copied to the sets only in the task that writes them.

    There are as many tasks as the copies ask for, so that those of one task can be sorted in memory.
    """
    copies = lines.agg(F.sum(F.size("keywords"))).first()[0] or 0
    _write_dealt(_dealt(lines, copies, lines_per_task), path, compression)


def _set_order() -> list[Column]:
    return [F.col("part"), F.col("followers").desc(), F.col("handle")]


def _dealt(lines: DataFrame, copies: int, lines_per_task: int) -> DataFrame:
    return lines.repartitionByRange(max(1, -(-copies // lines_per_task)), *_set_order())


def _write_dealt(dealt: DataFrame, path: str, compression: str) -> None:
    spread = dealt.select(F.explode("keywords").alias("keyword"), "part", "followers", "handle", "value")
    sorted_lines = spread.sortWithinPartitions("keyword", *_set_order())
    writer = sorted_lines.select("keyword", "value").write.mode("errorifexists")
    # The level counts for gzip alone.
    writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    writer.partitionBy("keyword").text(path)


def read_profile_sets(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, place, value): the lines of all sets in the order in which they stand, place 0 the header.

    The order is that of part files, of their blocks and of lines in them. A block is read by one task, so a line is numbered from the
    first of its block, and the text neither moves nor is written again.
    """
    return _placed(_standing_lines(spark.read.text(path))).select("keyword", "place", "value")


def _standing_lines(lines: DataFrame) -> DataFrame:
    return lines.filter("keyword is not null").select(
        "keyword", "value", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("_part"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
    )


def _placed(standing: DataFrame) -> DataFrame:
    return number_in_blocks(standing, ["keyword"], ["_part", "_block"], "_line", "_rn").withColumn("place", F.col("_rn") - 1)


LEAST_AT_ONCE = 500_000
TIMES_AT_ONCE = 3  # so often a round holds the text of a row


def rounds_of_sets(lines: DataFrame, at_once: int) -> tuple[list[list[str | None]], int]:
    """All keywords by round, with the lines of the largest one: those of a round have ``at_once`` lines or fewer, or it is one larger set.

    One row per keyword comes to the driver, as many as there are sets.
    """
    sizes = lines.select(F.explode("keywords").alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).orderBy("keyword").collect()
    rounds, most, left = [], 0, 0
    for keyword, n in sizes:
        if n > left:
            rounds.append([])
            left = max(at_once, n)
            room = left
        rounds[-1].append(keyword)
        left -= n
        most = max(most, room - left)
    return rounds, most


def _only(keywords: str, names: list[str | None]) -> Column:
    """The elements that are in ``names``."""
    missing = None in names
    return F.filter(keywords, lambda k: k.isin([n for n in names if n is not None]) | (k.isNull() if missing else F.lit(False)))


def read_back_sets(
    lines: DataFrame, path: str, columns: dict[str, Column], compression: str = "none",
    lines_per_task: int = LINES_PER_TASK, at_once: int | None = None,
) -> DataFrame:
    """(keyword, place, ``columns``) of all sets: written as :func:`write_profile_sets` does, read as :func:`read_profile_sets` does.

    All sets together hold the text of a row once per keyword, which no disk may have room for. So whole sets are written a round at a time, every
    line of theirs is read and what ``columns`` make of it stored, and the files go before the next round is written. ``lines`` stay: a set that is
    to be kept is written from them by :func:`write_profile_sets`. ``at_once`` is the number of lines in a round.
    """
    spark = lines.sparkSession
    rounds, most = rounds_of_sets(lines, at_once or max(LEAST_AT_ONCE, TIMES_AT_ONCE * lines.count()))
    if not rounds:
        return lines.select(F.lit("").alias("keyword"), F.lit(0).cast("bigint").alias("place"), *(c.alias(name) for name, c in columns.items())).limit(0)
    dealt = _dealt(lines, most, lines_per_task)
    if len(rounds) > 1:
        # Every round reads them in the order of their partitions. A lost one is dealt again from ``lines``.
        dealt = dealt.persist(StorageLevel.DISK_ONLY)
    paths, schema = [], None
    try:
        for i, names in enumerate(rounds):
            sets = f"{path}/round-{i}"
            _write_dealt(dealt.withColumn("keywords", _only("keywords", names)), sets, compression)
            # A schema, since a round may have only keywords that look like numbers.
            standing = _standing_lines(spark.read.schema("value string, keyword string").text(sets))
            read = standing.select("keyword", "_part", "_block", "_line", *(c.alias(name) for name, c in columns.items()))
            schema = read.schema
            paths.append(f"{path}/read-{i}")
            read.write.option("compression", "zstd").parquet(paths[-1])
            remove(spark, sets)
    finally:
        dealt.unpersist()
    return _placed(spark.read.schema(schema).parquet(*paths)).select("keyword", "place", *columns)
