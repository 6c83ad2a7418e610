"""Readers.  Raw columns are strings; null spellings become null; every row keeps
its place in the file in ``_seq``."""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolume.functions import NULL_TOKENS, STRICT_NULL_TOKENS, null_tokens
from agrolume.operators.dedupe import SEQ, file_order, keep_first
from agrolume.sources.streamed import head, reachable, streamed

_BAD = "_bad_line"
#: So many files are opened by the driver in turn, more of them in tasks.
DRIVER_HEADS = 32
_SEQ_TYPE = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row", T.LongType())]
)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files that a path, a folder or a pattern names, in any file system Spark knows.

    Folders are entered at any depth; names that start with a dot or an underscore are
    passed over.  What names no file at all is an error.
    """
    out = []
    for one in [path] if isinstance(path, str) else path:
        fs, jpath = _fs(spark, one)
        found, inside = list(fs.globStatus(jpath) or []), []
        while found:
            status = found.pop()
            if status.isDirectory():
                found += [x for x in fs.listStatus(status.getPath()) if x.getPath().getName()[0] not in "._"]
            else:
                inside.append(status.getPath().toString())
        if not inside:
            raise FileNotFoundError(f"no file in {one}")
        out += sorted(inside)
    return out


class Head(NamedTuple):
    """The first line of a file, None if it is empty, and whether the file is gzip."""

    line: str | None
    packed: bool


def head_of(spark: SparkSession, file: str, encoding: str = "UTF-8") -> Head:
    """The head of one file, read by the driver."""
    fs, jpath = _fs(spark, file)
    java, stream = spark._jvm.java, fs.open(jpath)
    try:
        start = java.io.BufferedInputStream(stream)
        start.mark(2)
        packed = (start.read(), start.read()) == (0x1F, 0x8B)
        start.reset()
        plain = java.util.zip.GZIPInputStream(start) if packed else start
        line = java.io.BufferedReader(java.io.InputStreamReader(plain, encoding)).readLine()
        return Head(None if line is None else line.removeprefix("\ufeff"), packed)
    finally:
        stream.close()


def heads_of(spark: SparkSession, files: list[str], encoding: str = "UTF-8") -> dict[str, Head]:
    """The heads of files, each opened once.

    Beyond ``DRIVER_HEADS`` files they are opened side by side in tasks; the driver gets
    a line for each.  Files of a file system that only Spark knows are opened in turn.
    """
    near = [f for f in files if reachable(f)] if len(files) > DRIVER_HEADS else []

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            lines, packed = zip(*(head(name, encoding) for name in names))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string()), pa.array(packed)], names=["file", "line", "packed"])

    out = {}
    if near:
        parts = min(len(near) // 8 + 1, 4 * spark.sparkContext.defaultParallelism)
        dealt = spark.createDataFrame([(f,) for f in near], "file string").repartition(parts)
        found = dealt.mapInArrow(opened, "file string, line string, packed boolean")
        out = {r["file"]: Head(r["line"], r["packed"]) for r in found.collect()}
    return {f: out[f] if f in out else head_of(spark, f, encoding) for f in files}


def header_names(line: str, sep: str, ignore_leading_space: bool = True) -> tuple[str, ...]:
    """Column names of a header line; a name that repeats gets its place appended."""
    names = next(csv.reader([line], delimiter=sep, skipinitialspace=ignore_leading_space), [])
    return tuple(n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _fields(line: Column, sep: str) -> Column:
    """Number of fields of a raw line; separators inside quotes do not count."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), re.escape(sep), -1))


def _parsed(
    spark: SparkSession,
    files: list[str],
    names: tuple[str, ...],
    sep: str,
    encoding: str,
    bad_lines: str,
    ignore_leading_space: bool,
    multiline: bool,
) -> DataFrame:
    """Files of one layout."""
    strict = bad_lines != "cut"
    fields = [T.StructField(n, T.StringType()) for n in (*names, _BAD)[: len(names) + strict]]
    raw = (
        spark.read.schema(T.StructType(fields))
        .option("encoding", encoding)
        .option("columnNameOfCorruptRecord", _BAD)
        # With pruned parsing Spark does not notice lines of the wrong length.
        .option("columnPruning", str(not strict).lower())
        .csv(
            files,
            sep=sep,
            header=True,
            escape='"',
            mode="PERMISSIVE",
            multiLine=multiline,
            ignoreLeadingWhiteSpace=ignore_leading_space,
        )
        .withColumn(SEQ, file_order())
    )
    if not strict:
        return raw
    # Spark refuses to read the bad-line column alone (as for a count), so the
    # filter also touches a data column; its second half is always true.
    fits = F.col(_BAD).isNull() | (_fields(F.col(_BAD), sep) <= len(names))
    if bad_lines == "raise":
        fits = fits | F.raise_error(F.concat(F.lit("more fields than the header has: "), F.substring(_BAD, 1, 200))).cast("boolean")
    return raw.where(fits & (F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0)).drop(_BAD)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    bad_lines: str = "raise",
    ignore_leading_space: bool = False,
    tokens: tuple[str, ...] = NULL_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    """Delimited text, each file by its own header; columns unite by name.

    Short lines are filled with nulls.  Lines with too many fields stop the read
    (``bad_lines="raise"``), are left out (``"skip"``, see ``bad_lines_of``) or lose
    the surplus (``"cut"``, which alone lets Spark parse only the columns in use).
    Line ends may be LF or CRLF.  Plain files split freely unless ``multiline`` (line
    breaks inside quotes) is asked for.  Gzip files under any name are streamed, one
    task each, and keep line breaks inside quotes.
    """
    layouts: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for file, (line, packed) in heads_of(spark, files_of(spark, path), encoding).items():
        if line is not None:
            # Spark itself unpacks what is called .gz; gzip under another name is streamed.
            streams = packed and not file.endswith(".gz")
            layouts.setdefault((header_names(line, sep, ignore_leading_space), streams), []).append(file)
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField(SEQ, _SEQ_TYPE)]))
    frames = [
        _unpacked(spark, f, n, sep, encoding, bad_lines, ignore_leading_space)
        if packed
        else _parsed(spark, f, n, sep, encoding, bad_lines, ignore_leading_space, multiline)
        for (n, packed), f in layouts.items()
    ]
    return null_tokens(union_all(frames), tokens)


def bad_lines_of(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """(file, n): lines with more fields than the header of their file has; empty files have no row."""
    layouts: dict[tuple[int, bool], list[str]] = {}
    for file, (line, packed) in heads_of(spark, files_of(spark, path), encoding).items():
        if line is not None:
            layouts.setdefault((len(header_names(line, sep)), packed), []).append(file)
    counts = []
    for (width, packed), files in layouts.items():
        if packed:
            lines = streamed(spark, files, "lines", sep, encoding)
        else:
            # The name as files_of gives it: Spark has it as a URI.
            name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
            text = spark.read.option("encoding", encoding).text(files)
            lines = text.select(F.regexp_replace(name, "^file:/+", "file:/").alias("file"), "value")
        wide = (_fields(F.col("value"), sep) > width).cast("long")
        counts.append(lines.groupBy("file").agg(F.sum(wide).alias("n")))
    return union_all(counts) if counts else spark.createDataFrame([], "file string, n bigint")


def read_cultivares(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Cultivar register: comma, UTF-8, dashes are null."""
    return read_delimited(spark, path, ignore_leading_space=True, tokens=STRICT_NULL_TOKENS, multiline=multiline)


def read_conab(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Production and price text files: semicolon, Latin-1.  Their fields hold no line
    breaks, so the large ones split; ``multiline`` is for files that do."""
    return read_delimited(spark, path, ";", "ISO-8859-1", ignore_leading_space=True, multiline=multiline)


# File name of each dataset.
CONAB_FILES = {
    "producao_historica": "SerieHistoricaGraos.txt",
    "producao_estimativa": "LevantamentoGraos.txt",
    "precos_uf_mensal": "PrecosMensalUF.txt",
    "precos_mun_mensal": "PrecosMensalMunicipio.txt",
    "precos_uf_semanal": "PrecosSemanalUF.txt",
    "precos_mun_semanal": "PrecosSemanalMunicipio.txt",
}
SEED_FILES = {
    "campos_producao": ("campos_producao.csv",),
    "reserva_semente": ("uso_proprio.csv", "reserva_semente.csv"),
}


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def read_each(readers: dict[str, Callable[[], DataFrame]], failed: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The datasets that can be opened.

    One that can't (broken packing, a name that is a folder without files) does not
    stop the others: it is left out, told by a warning, and put in ``failed``.  Errors
    that show only while rows are read appear in the job of that dataset.
    """
    out = {}
    for key, read in readers.items():
        try:
            out[key] = read()
        except Exception as error:  # noqa: BLE001 whatever it is, it belongs to this dataset
            message = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
            warnings.warn(f"{key} was left out: {message}", stacklevel=2)
            if failed is not None:
                failed[key] = message
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of one's own."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def read_conab_folder(spark: SparkSession, folder: str, failed: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The datasets present in a folder; absent files are skipped, unreadable ones are told (``read_each``)."""
    paths = {k: f"{folder}/{n}" for k, n in CONAB_FILES.items()}
    return read_each({k: lambda p=p: read_conab(spark, p) for k, p in paths.items() if exists(spark, p)}, failed)


def read_agrofit(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Pesticide register: semicolon, UTF-8, overlong lines skipped."""
    return read_delimited(spark, path, ";", bad_lines="skip", multiline=multiline)


def read_fertilizantes(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Fertilizer establishments: semicolon, Latin-1."""
    return read_delimited(spark, path, ";", "ISO-8859-1", ignore_leading_space=True, multiline=multiline)


def read_sigef_folder(spark: SparkSession, folder: str, failed: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Seed production and seed reserve; the reserve has an alternate file name.
    Unreadable files are told (``read_each``)."""
    found = {}
    for key, names in SEED_FILES.items():
        path = next((p for n in names if exists(spark, p := f"{folder}/{n}")), None)
        if path:
            found[key] = lambda p=path: read_delimited(spark, p, ";", bad_lines="skip")
    return read_each(found, failed)


def read_any_gzip(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    partitions: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Delimited text that may be gzip under any name; overlong lines skipped.

    Plain files split freely.  A gzip stream cannot be split: one task unpacks each
    such file as it reads, then the records spread over ``partitions`` and parse in the
    JVM.  Each file is read by its own header.  With ``columns`` only those of them that
    a file has are taken out of its lines, and what a line holds beyond its header is not
    looked at.
    """
    plain, packed = [], {}
    for file, (line, is_packed) in heads_of(spark, files_of(spark, path)).items():
        if not is_packed:
            plain.append(file)
        elif line is not None:
            packed.setdefault(header_names(line, sep), []).append(file)
    bad = "skip" if columns is None else "cut"
    frames = [null_tokens(_unpacked(spark, f, names, sep, "UTF-8", bad, False, partitions, columns)) for names, f in packed.items()]
    if plain or not frames:
        whole = read_delimited(spark, plain, sep, bad_lines=bad)
        frames.append(whole if columns is None else whole.select(*[c for c in columns if c in whole.columns], SEQ))
    return union_all(frames)


def _unpacked(
    spark: SparkSession,
    files: list[str],
    names: tuple[str, ...],
    sep: str,
    encoding: str,
    bad_lines: str,
    ignore_leading_space: bool,
    partitions: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Gzip files of one layout."""
    lines = streamed(spark, files, "records", sep, encoding).where("row > 0 AND value <> ''")
    spread = lines.repartition(partitions or spark.sparkContext.defaultParallelism)
    place = _seq(F.col("file"), F.lit(0), F.col("row")).alias(SEQ)
    strict = bad_lines != "cut"
    quoted = {n: "`" + n.replace("`", "``") + "`" for n in (*names, _BAD)[: len(names) + strict]}
    schema = ", ".join(f"{q} string" for q in quoted.values())
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": str(ignore_leading_space).lower()}
    if strict:
        options["columnNameOfCorruptRecord"] = _BAD
    record = F.from_csv("value", schema, options)
    if columns is not None:
        wanted = [n for n in names if n in set(columns)]
        if not wanted:
            return spread.select(place)
        # Up to the last wanted column a line is cut at its separators; the rest stays one piece.
        # So is one whose quotes up to there enclose whole fields, without a separator or another quote.
        places = [names.index(n) for n in wanted]
        cut = F.split("value", re.escape(sep), max(places) + 2)
        piece = rf'(?:"[^"{re.escape(sep)}]+"|[^"{re.escape(sep)}]*)'
        simple = ~F.contains("value", F.lit('"')) | F.col("value").rlike(rf"\A{piece}(?:{re.escape(sep)}{piece}){{{max(places)}}}(?:{re.escape(sep)}|\z)")
        field = lambda n, i: F.when(simple, F.btrim(F.get(cut, F.lit(i)), F.lit('"'))).otherwise(record.getField(n))
        return spread.select(*[field(n, i).alias(n) for n, i in zip(wanted, places)], place)
    parsed = spread.select(place, record.alias("r"))
    if strict:
        fits = F.col(f"r.{_BAD}").isNull() | (_fields(F.col(f"r.{_BAD}"), sep) <= len(names))
        if bad_lines == "raise":
            fits = fits | F.raise_error(F.concat(F.lit("more fields than the header has: "), F.substring(f"r.{_BAD}", 1, 200))).cast("boolean")
        parsed = parsed.where(fits)
    return parsed.select(*[F.col(f"r.{quoted[n]}") for n in names], SEQ)


def is_gzip(spark: SparkSession, path: str) -> bool:
    """Whether a file starts with the gzip mark."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return (stream.read(), stream.read()) == (0x1F, 0x8B)
    finally:
        stream.close()


def read_zarc(spark: SparkSession, folder: str, crops: Sequence[str]) -> DataFrame:
    """Per-crop files ``zarc_<crop>.csv``, gzip or not; the crop comes from
    ``Nome_cultura``, else ``cultura_raw``, else the file name."""
    frames = []
    for crop in crops:
        path = f"{folder}/zarc_{crop}.csv"
        if not exists(spark, path):
            continue
        frames.append(with_crop(read_any_gzip(spark, path), F.lit(crop)))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField("cultura_raw", T.StringType()), T.StructField(SEQ, _SEQ_TYPE)]))
    return union_all(frames)


def read_zarc_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Some risk files, gzip or not, each by its own header; the crop as in ``read_zarc``."""
    crop = lambda f: re.sub(r"^zarc_|\.[^.]*$", "", f.rstrip("/").rpartition("/")[2])
    return union_all([with_crop(read_any_gzip(spark, f), F.lit(crop(f))) for f in files])


def _seq(file: Column, block: Column, row: Column) -> Column:
    return F.struct(file.alias("file"), block.cast("bigint").alias("block"), row.cast("bigint").alias("row"))


def with_crop(df: DataFrame, fallback: Column) -> DataFrame:
    if "Nome_cultura" in df.columns:
        return df.withColumn("cultura_raw", F.col("Nome_cultura"))
    return df if "cultura_raw" in df.columns else df.withColumn("cultura_raw", fallback)


def read_zarc_places(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A risk file, gzip or not, for ``zarc_municipios``: only the columns in use are
    taken, and what a line holds beyond its header is not looked at."""
    return read_any_gzip(spark, path, columns=PLACE_COLUMNS)


PLACE_COLUMNS = ("cod_municipio_ibge", "municipio", "uf")


def zarc_municipios(df: DataFrame) -> DataFrame:
    """Distinct municipalities of a risk file."""
    geo = list(PLACE_COLUMNS)
    order = [SEQ] if SEQ in df.columns else None
    if "cod_municipio_ibge" not in df.columns:
        return df.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in geo))
    rows = df.select(*geo, *(order or []))
    # Equal rows are one first, by hash: few are left to be put in order.
    if order is None:
        rows = rows.distinct()
    elif getattr(rows.schema[SEQ].dataType, "names", None) == _SEQ_TYPE.names:
        rows = rows.select(*geo, f"{SEQ}.*").groupBy(*geo, "file", "block").agg(F.min("row").alias("row"))
        rows = rows.select(*geo, _seq(F.col("file"), F.col("block"), F.col("row")).alias(SEQ))
    return keep_first(rows, ["cod_municipio_ibge"], order).select(*geo)


_PAM_COLUMNS = ("D2N", "V", "D1C", "D1N", "D3N")


def read_pam_long(spark: SparkSession, path: str | list[str], crop_in_path: str = r"([^/_]+)\.json$") -> DataFrame:
    """Statistics payloads, one JSON list per file, gzip or not; the first record is the header.

    The crop is what ``crop_in_path`` finds in the path (``pam_soja.json``).  A payload
    is cut into its records as it streams, so it may be of any size.
    """
    record = "struct<" + ",".join(f"{c}:string" for c in _PAM_COLUMNS) + ">"
    rows = streamed(spark, files_of(spark, path), "elements").where("row > 0").select(
        F.url_decode(F.regexp_extract("file", crop_in_path, 1)).alias("cultura_raw"),
        F.from_json("value", record).alias("r"),
    )
    return null_tokens(rows.select("r.*", "cultura_raw"))


def read_municipios_json(spark: SparkSession, path) -> DataFrame:
    """Official municipality list with its two region hierarchies."""
    schema = (
        "id string, nome string, "
        "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>, "
        "`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>"
    )
    return spark.read.schema(schema).json(path, multiLine=True)


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed in some tasks for each core; by default it is one task for each folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, wanted = int(spark.conf.get(name)), 4 * spark.sparkContext.defaultParallelism
    spark.conf.set(name, str(min(before, wanted)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


WEATHER_VARIABLES = ("precipitation_sum", "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean")


def read_weather_json(spark: SparkSession, path, pattern: str = r"(\d+)\.json$") -> DataFrame:
    """Daily weather, one JSON object per municipality with parallel arrays; one
    row per day.  The municipality code is what ``pattern`` finds in the path."""
    daily = "daily struct<time: array<string>, " + ", ".join(f"{v}: array<double>" for v in WEATHER_VARIABLES) + ">"
    with _listing(spark):
        raw = spark.read.schema(daily).json(path, multiLine=True)
    raw = raw.withColumn("codigo_ibge", F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)))
    return explode_daily(raw)


def explode_daily(df: DataFrame) -> DataFrame:
    """Struct ``daily`` of parallel arrays to one row per day."""
    others = [c for c in df.columns if c != "daily"]
    names = ("time", *WEATHER_VARIABLES)
    # A variable that a payload lacks is null on its days; the days stay.
    present = [F.coalesce(F.col(f"daily.{n}"), F.array().cast(f"array<{'string' if n == 'time' else 'double'}>")) for n in names]
    zipped = F.arrays_zip(*[c.alias(n) for c, n in zip(present, names)])
    return df.select(*others, F.inline(zipped))


def read_coords(spark: SparkSession, path) -> DataFrame:
    """codigo_ibge, latitude, longitude of municipalities; other columns are ignored."""
    df = spark.read.csv(path, header=True)
    return df.select("codigo_ibge", *[F.col(c).try_cast("double").alias(c) for c in ("latitude", "longitude")])
