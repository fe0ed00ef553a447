"""Raw survey files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions.text import strip_spaces
from surveyloom.sources.workspace import written

FALLBACK_ENCODING = "ISO-8859-1"
#: Four digits that are a number of their own.
YEAR_IN_NAME = re.compile(r"(?<!\d)\d{4}(?!\d)")
#: Column that tells the edition of a row's file.
EDITION = "edicao_do_arquivo"
#: Fields that are quoted as a whole or hold no quote, between commas.
_FIELD = r'(?:(?:"[^"]*+")++|[^",]*+)'
_WHOLE_LINE = rf"^{_FIELD}(?:,{_FIELD})*+\z"
_QUOTED = '"[^"]*+"'
#: A line of white space alone is a row to one reader and none to the other.
_BLANK = r"^[\x00-\x20]++\z"


@dataclass(frozen=True)
class RawFile:
    """What the one look at a raw file tells: its encoding and a digest of its header line."""

    address: str
    """As scans name it: characters such as blanks are encoded."""
    year: int
    encoding: str
    header: str
    splittable: bool = False
    """Whether every line is a row by itself, so that tasks can share the file."""

    @property
    def path(self) -> str:
        return unquote(self.address)


def inspect_files(
    spark: SparkSession, paths: Mapping[int, str | Sequence[str]]
) -> list[RawFile]:
    """Edition, encoding and header digest of every file, from one pass over the text.

    A file is UTF-8 where every line is, else Latin-1. It can be split where every line is made of whole
    fields, as many as in any other line: then no field holds a line break. One row for each file comes
    back, as from any listing of a folder.
    """
    editions = [
        spark.read.text(given).select(
            F.lit(year).alias("year"), "value", "_metadata.file_path", "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("place"),
        )
        for year, given in paths.items()
    ]
    lines = reduce(DataFrame.unionAll, editions)
    first = F.min_by(F.struct("value"), F.struct("file_block_start", "place"))
    whole = F.col("value").rlike(_WHOLE_LINE) & ~F.col("value").rlike(_BLANK)
    bare = F.regexp_replace("value", _QUOTED, "")
    commas = F.when(F.col("value") != "", F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))))
    # A set, since with it Spark aggregates by hash; the text of ``first`` alone would have every line
    # of every file sorted.
    files = lines.groupBy("year", "file_path").agg(
        F.collect_set(F.is_valid_utf8("value")).alias("utf8"),
        F.sha2(first["value"].cast("binary"), 256).alias("header"),
        (F.bool_and(whole) & F.min(commas).eqNullSafe(F.max(commas))).alias("splittable"),
    )
    return [
        RawFile(
            r["file_path"], r["year"], "UTF-8" if all(r["utf8"]) else FALLBACK_ENCODING,
            r["header"], r["splittable"],
        )
        for r in files.orderBy("file_path").collect()
    ]


def detect_encodings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by encoding. Reads the text once more; pass the encoding where it is known."""
    out: dict[str, list[str]] = {}
    for file in inspect_files(spark, {0: path}):
        out.setdefault(file.encoding, []).append(file.path)
    return out


def read_survey_csv_any(spark: SparkSession, path: str) -> DataFrame:
    """``read_survey_csv`` of a folder whose files may differ in encoding.

    Columns are matched by their headers; files of different encodings must have the same ones.
    """
    parts = [
        read_survey_csv(spark, files, encoding)
        for encoding, files in detect_encodings(spark, path).items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else read_survey_csv(spark, path)


def read_survey_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", splittable: bool = False
) -> DataFrame:
    """All columns as text; quoted fields may hold commas, quotes and line breaks.

    The header of every file is checked: files with other columns, or the same ones in another
    order, make the read fail instead of mixing answers up.

    A file with line breaks inside fields cannot be split, so parallelism comes from the number
    of files: land such an edition as many files rather than one. ``splittable`` says that no field
    of these files holds a line break, as ``inspect_files`` finds; any number of tasks then share a file.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", not splittable)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def number_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(arquivo, linha, linha_bruta)`` of text files; the first line of a file is number 1.

    Lines are landed with the block they stand in and their place in the task that read them.
    Places of one block follow each other, so a line number is the lines of earlier blocks of the
    file plus the distance from the first place: only counts of blocks are shuffled and joined.
    """
    landed = written(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("arquivo"),
            F.col("_metadata.file_block_start").alias("bloco"),
            F.monotonically_increasing_id().alias("lugar"),
            F.col("value").alias("linha_bruta"),
        ),
        "linhas",
    )
    blocks = landed.groupBy("arquivo", "bloco").agg(
        F.min("lugar").alias("primeiro"), F.count(F.lit(1)).alias("linhas")
    )
    earlier = Window.partitionBy("arquivo").orderBy("bloco").rowsBetween(
        Window.unboundedPreceding, Window.currentRow - 1
    )
    # Stored, so that Spark knows that there are few and does not shuffle the lines to meet them.
    offsets = written(
        blocks.withColumn("antes", F.coalesce(F.sum("linhas").over(earlier), F.lit(0))), "blocos"
    )
    return landed.join(offsets, ["arquivo", "bloco"]).select(
        "arquivo",
        (F.col("antes") + F.col("lugar") - F.col("primeiro") + 1).alias("linha"),
        "linha_bruta",
    )


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of the files for lineage, without the header: the first line of each file.

    A header is told by its place, so files may have different ones and a data line that reads like
    a header stays.
    """
    return number_lines(spark, path).where(F.col("linha") > 1)


def edition_path(base: str, year: int, folder: str = "edicao_{ano}") -> str:
    """Folder of an edition below the bronze folder."""
    return f"{base.rstrip('/')}/{folder.format(ano=year)}"


def files_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files below a path; only folders are listed."""
    return sorted(map(unquote, spark.read.text(path).inputFiles()))


def editions_by_name(spark: SparkSession, folder: str) -> dict[int, list[str]]:
    """CSV files of a folder by the year in their names; files without a year are left out."""
    out: dict[int, list[str]] = {}
    for file in files_of(spark, folder):
        name = file.rsplit("/", 1)[-1]
        year = YEAR_IN_NAME.search(name)
        if year and name.lower().endswith(".csv"):
            out.setdefault(int(year[0]), []).append(file)
    return dict(sorted(out.items()))


def locate_edition(spark: SparkSession, folder: str, year: int) -> str | None:
    """First CSV file in a folder whose name holds the year."""
    return next(iter(editions_by_name(spark, folder).get(year, ())), None)


@dataclass(frozen=True)
class RawGroup:
    """Files of one encoding and one header, of however many editions: one scan."""

    encoding: str
    files: list[RawFile]

    @property
    def editions(self) -> list[int]:
        return sorted({file.year for file in self.files})


def group_files(
    spark: SparkSession, paths: Mapping[int, str | Sequence[str]], encoding: str = "auto"
) -> list[RawGroup]:
    """Files of all editions, grouped by encoding and header, after one look at each."""
    groups: dict[tuple[str, str], list[RawFile]] = {}
    for file in inspect_files(spark, paths):
        kind = file.encoding if encoding == "auto" else encoding
        groups.setdefault((kind, file.header), []).append(file)
    return [RawGroup(kind, files) for (kind, _), files in groups.items()]


def read_group(spark: SparkSession, group: RawGroup) -> DataFrame:
    """All files of a group; ``edicao_do_arquivo`` is the edition of a row's file.

    One read, or two where some files have line breaks in fields: those that do not are split.
    """
    address = F.col("_metadata.file_path")
    of_year = {y: [f.address for f in group.files if f.year == y] for y in group.editions}
    cases = [F.when(address.isin(files), F.lit(year)) for year, files in of_year.items()]
    # The look at the lines is one at ASCII bytes, which these two encodings share.
    lines_known = group.encoding.upper() in ("UTF-8", FALLBACK_ENCODING)
    kinds: dict[bool, list[str]] = {}
    for file in group.files:
        kinds.setdefault(file.splittable and lines_known, []).append(file.path)
    return reduce(
        DataFrame.unionAll,
        [
            read_survey_csv(spark, files, group.encoding, splittable).select(
                "*", F.coalesce(*cases).alias(EDITION)
            )
            for splittable, files in kinds.items()
        ],
    )


def project_columns(
    raw: DataFrame, columns: Mapping[str, str], kept: Sequence[Column] = ()
) -> DataFrame:
    """Canonical names for the resolved columns, trimmed; blank text is NULL.

    Back-ticks are doubled because headers may hold dots, quotes and back-ticks. Columns ``kept`` stay
    as they are.
    """
    return raw.select(
        *kept,
        *[
            F.nullif(strip_spaces(F.col(f"`{header.replace('`', '``')}`")), F.lit("")).alias(name)
            for name, header in columns.items()
        ]
    )


def with_respondent_key(landed: DataFrame, year: int) -> DataFrame:
    """Edition and respondent key, from the place of the row in the landed Parquet files.

    ``monotonically_increasing_id`` depends on how a read happens to be split. File and row number
    are stored facts, so every evaluation, also one after an executor is lost, gives the same key.
    """
    return landed.select(
        F.lit(year).alias("ano"),
        F.concat_ws(
            "-",
            F.lit(year),
            F.hex(F.xxhash64("_metadata.file_name")),
            F.col("_metadata.row_index"),
        ).alias("id_respondente"),
        "*",
    )


def answers_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of all answers of a row, whatever the order of the columns; no answer is no text."""
    parts = [
        F.coalesce(F.concat(F.lit(f"{name}="), F.octet_length(name), F.lit(":"), F.col(name)), F.lit(""))
        for name in sorted(columns)
    ]
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)


def with_content_key(landed: DataFrame, edition: str = "ano", block: int = 100_000) -> DataFrame:
    """``id_respondente`` from the answers themselves, so that a second load gives the same keys.

    The key is edition, digest of all answers, and a number among equal rows. Equal rows can't be told
    apart, so it does not matter which gets which number, and the set of keys depends neither on
    files nor on their order. They are numbered in blocks of a stored file: counts of a row's blocks
    are added up in order, and inside a block rows are numbered by place. A row that fills a third
    of the table is thus spread over its blocks; rows that occur once are not shuffled at all.
    ``landed`` is a stored Parquet table, whose rows have a place.
    """
    answers = [c for c in landed.columns if c != edition]
    placed = landed.select(
        "*",
        F.col("_metadata.file_path").alias("arquivo_"),
        F.col("_metadata.row_index").alias("linha_"),
        answers_digest(answers).alias("digesto_"),
    )
    keys = written(
        placed.select(edition, F.unhex("digesto_").alias("digesto_"), "arquivo_", "linha_"), "digestos"
    ).withColumn("bloco_", F.floor(F.col("linha_") / block))
    content, where = [edition, "digesto_"], ["arquivo_", "bloco_"]
    # Stored, so that Spark knows how few they may be. Only these rows go on; of the others no more
    # than edition and digest is shuffled.
    several = written(
        keys.groupBy(*content).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1").select(*content),
        "iguais",
    )
    # Stored too: a row that fills a third of the table may then be spread over the tasks of the join.
    equal = written(keys.join(several, content), "linhas_iguais")
    counts = equal.groupBy(*content, *where).agg(F.count(F.lit(1)).alias("linhas"))
    earlier = Window.partitionBy(*content).orderBy(*where).rowsBetween(
        Window.unboundedPreceding, Window.currentRow - 1
    )
    before = counts.select(
        *content, *where, F.coalesce(F.sum("linhas").over(earlier), F.lit(0)).alias("antes")
    )
    # An edition is never null here, nor is a digest: plain equality will do.
    in_block = Window.partitionBy(*content, *where).orderBy("linha_")
    numbered = written(
        equal.join(before, [*content, *where]).select(
            "arquivo_", "linha_", (F.col("antes") + F.row_number().over(in_block)).alias("vez_")
        ),
        "repetidas",
    )
    key = F.concat_ws("-", edition, F.left("digesto_", F.lit(32)), F.coalesce("vez_", F.lit(1)))
    return placed.join(numbered, ["arquivo_", "linha_"], "left").select(
        edition, key.alias("id_respondente"), *answers
    )


def land_group(raw: DataFrame, columns: Mapping[str, str], path: str) -> DataFrame:
    """Write the needed columns of all editions of a group as Parquet once; read them back with keys.

    Some 30 of 400 columns are kept, the unsplittable CSV is parsed a single time, and both silver
    tables start from the same stored rows.
    """
    spark = raw.sparkSession
    projected = project_columns(raw, columns, kept=[F.col(EDITION).alias("ano")])
    projected.write.mode("overwrite").parquet(path)
    return with_content_key(spark.read.schema(projected.schema).parquet(path))
