"""Bronze sources: landed JSON documents ``{meta, results[]}`` and ZIP exports.

Documents come as *JSON Lines* (one document per line, many per file), which
Spark splits freely, or as one document per file over many lines
(pretty-printed). The layout is found out, not assumed. A multi-line file is one
split (one task), so writers here produce JSON Lines documents of bounded size.

Nothing is lost silently. A line or file that is no whole document - cut off,
followed by something else, of other types, without ``meta`` and ``results`` - is
a *reject*: :func:`read_bronze` fails on it, :func:`land_bronze` reads
everything in one parse, keeps rejects with their file and text, and compares the
records that documents announce with those they hold.
"""

from __future__ import annotations

import io
import json
import logging
import re
import uuid
import zipfile
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import dates
from ..schemas import BRONZE_DOCUMENT, META, RECORD, RECORD_FIELDS
from ..session import scratch_path, ship_package
from .tables import _hadoop_fs, qualified_path, remove_path, write_table

_LOG = logging.getLogger(__name__)

#: Metadata is read as text and cast, so that a number written as text makes
#: no document unreadable.
_META_TEXT = StructType([StructField(f.name, StringType(), True) for f in META])
_DOCUMENTS = StructType([
    StructField("d", ArrayType(StructType([StructField("meta", _META_TEXT), StructField("results", ArrayType(RECORD))]))),
    StructField("_corrupt", StringType()),
])
#: What the layout test reads: so many files, so many bytes of each.
PEEK_FILES, PEEK_BYTES = 16, 1 << 16
#: A line that begins a document, whole or not.
_BEGINS = re.compile(r'^[\ufeff\s]*\{\s*"')


class LostRecords(RuntimeError):
    """Documents could not be read, or hold fewer records than they announce."""


def _typed_meta(meta):
    strings = ArrayType(StringType())
    return F.when(meta.isNotNull(), F.struct(*[
        (F.from_json(meta[f.name], strings) if f.dataType == strings else meta[f.name].try_cast(f.dataType)).alias(f.name)
        for f in META
    ]))


def parse_documents(lines: DataFrame) -> DataFrame:
    """(file, text) of lines or whole files -> (file, text, reason, meta,
    results): ``reason`` says why a text is no document, else it is null. Blank texts
    are dropped."""
    text = F.regexp_replace("text", "^\ufeff", "")
    # As the one element of an array: what follows a document is then an error
    # instead of being passed over.
    wrapped = F.concat(F.lit('{"d":['), text, F.lit("\n]}"))
    parsed = F.from_json(wrapped, _DOCUMENTS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    blank = ~F.col("text").rlike(r"[^\ufeff\s]")
    out = lines.filter(~blank).withColumn("p", parsed)
    document = F.get("p.d", F.lit(0))
    # Filters may be evaluated in any order: a blank text has no reason either.
    reason = F.when(blank, F.lit(None)).when(F.col("p._corrupt").isNotNull() | F.col("p").isNull(), F.lit("no whole JSON document")).when(
        (F.size("p.d") != 1) | document.isNull() | (document["meta"].isNull() & document["results"].isNull()),
        F.lit("not one object with meta or results"),
    )
    return out.select(
        "file", "text", reason.alias("reason"), _typed_meta(document["meta"]).alias("meta"), document["results"].alias("results")
    )


def _texts(reader, path, multiline: bool) -> DataFrame:
    """(file, text) of every line, or of every file."""
    return reader.option("wholetext", multiline).format("text").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def find_layout(spark: SparkSession, path) -> bool:
    """True if the files at ``path`` hold one document over many lines each,
    judged by the first lines of up to PEEK_FILES files spread over the listing:
    no line of any of them is a document. Files of another layout than the
    others are rejects later, not lost."""
    seen = _peek_layouts(spark, path)
    return bool(seen) and all(seen)


def _peek_layouts(spark: SparkSession, path) -> list[bool]:
    """Of each file looked into: does it hold one document over many lines?"""
    files = sorted(spark.read.format("text").load(path).inputFiles())
    step = max(1, -(-len(files) // PEEK_FILES))
    return [not _has_document_line(spark, f) for f in files[::step]]


def multiline_files(texts: DataFrame) -> list[str]:
    """Files of (file, line) rows that hold one document over many lines: no
    line of them has the ends of an object, so that none is a document, and some
    do not even begin one. Nothing is parsed for it."""
    c = F.col("text")
    ends = c.rlike(r"^[\ufeff\s]*\{") & c.rlike(r"\}\s*$")
    per_file = texts.filter(c.rlike(r"[^\ufeff\s]")).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if(ends).alias("good"), F.count_if(c.rlike(_BEGINS.pattern)).alias("begun")
    )
    return sorted(r["file"] for r in per_file.filter("good = 0 and n > 1 and begun < n").select("file").collect())


def _has_document_line(spark: SparkSession, file: str) -> bool:
    jvm = spark.sparkContext._jvm
    fs, _ = _hadoop_fs(spark, file)
    name = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(name)
    stream = fs.open(name)
    try:
        stream = stream if codec is None else codec.createInputStream(stream)
        head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
            jvm.org.apache.commons.io.input.BoundedInputStream(stream, PEEK_BYTES)
        )).decode("utf-8", "replace")
    finally:
        stream.close()
    lines = [x for x in head.lstrip("\ufeff").split("\n") if x.strip()]
    if len(lines) <= 1 or all(_BEGINS.match(x) for x in lines):  # one (long) line, or documents all cut off
        return True
    for line in lines:
        try:
            value = json.loads(line)
        except ValueError:
            continue
        if isinstance(value, dict) and value.keys() & {"meta", "results"}:
            return True
    return False


def read_bronze_documents(spark: SparkSession, path, multiline: bool | None = None, strict: bool = True) -> DataFrame:
    """(meta, results) of every document. ``multiline`` None finds the layout
    out. A text that is no document fails the query, or with
    ``strict=False`` gives no row."""
    if multiline is None:
        multiline = find_layout(spark, path)
    parsed = parse_documents(_texts(spark.read, path, multiline))
    if not strict:
        return parsed.filter("reason is null").select("meta", "results")
    complaint = F.concat(F.lit("unreadable document ("), "reason", F.lit(") in "), "file", F.lit(": "), F.substring("text", 1, 200))
    checked = F.when(F.col("reason").isNotNull(), F.raise_error(complaint).cast(BRONZE_DOCUMENT["results"].dataType))
    return parsed.select("meta", checked.otherwise(F.col("results")).alias("results"))


def explode_records(documents: DataFrame) -> DataFrame:
    """One row per element of ``results`` (empty or NULL arrays give none)."""
    # Not the bare column: for that, Spark adds a filter on its size and puts it
    # below the parse, which then parses every document again.
    results = F.coalesce("results", F.array().cast(documents.schema["results"].dataType))
    return documents.select(F.explode(results).alias("r")).select(
        *[F.col(f"r.{f}").alias(f) for f in RECORD_FIELDS]
    )


def read_bronze(spark: SparkSession, path, multiline: bool | None = None, repartition: int | None = None) -> DataFrame:
    """Bronze document(s) -> 19 flat string fields, one row per record. A
    document that cannot be read fails the query; :func:`land_bronze` puts it
    aside instead.

    ``repartition`` spreads records after the explode, for inputs made of
    a few very large multiline files (each of which is a single task).
    """
    out = explode_records(read_bronze_documents(spark, path, multiline))
    return out.repartition(repartition) if repartition else out


@dataclass
class Landed:
    """What one parse of landed documents found."""

    records: DataFrame  # 19 flat string fields
    rejects: DataFrame  # file, reason, text
    documents: int
    rejected: int
    announced: int  # as the documents say; what they hold where they do not
    held: int
    source: str | None
    warning: str | None
    announces_nothing: bool
    paths: list[str]

    @property
    def loss(self) -> str | None:
        """What is missing, in words."""
        said = []
        if self.rejected:
            files = ", ".join(sorted(r["file"] for r in self.rejects.select("file").distinct().limit(5).collect()))
            said.append(f"{self.rejected} unreadable document(s), in {files}")
        if self.held < self.announced:
            said.append(f"{self.announced} records announced, {self.held} read")
        return "; ".join(said) or None

    def discard(self) -> None:
        """Delete the written parse, once what was made of it is written."""
        for path in self.paths:
            remove_path(self.records.sparkSession, path)


_PARSED = StructType([StructField("kind", StringType()), StructField("announced", META["records_fetched"].dataType),
                      StructField("held", META["records_fetched"].dataType), StructField("source", StringType()),
                      StructField("warning", StringType()), StructField("reason", StringType()),
                      StructField("text", StringType()), StructField("r", RECORD)])


def _tagged(kind: str, **values):
    return F.struct(*[
        (F.lit(kind) if f.name == "kind" else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in _PARSED
    ])


def _write_parsed(texts: DataFrame, path: str) -> dict:
    """Parse once: a row for every document, record and reject is written,
    and the counts are observed on the way."""
    held = F.coalesce(F.array_size("results"), F.lit(0)).cast("long")
    parsed = parse_documents(texts).withColumn("held", held).withColumn(
        "announced", F.when(F.col("reason").isNull(), F.coalesce("meta.records_fetched", "held"))
    )
    seen = Observation(f"bronze-{uuid.uuid4().hex[:8]}")
    good = F.col("reason").isNull()
    parsed = parsed.observe(
        seen, F.count_if(good).alias("documents"), F.count_if(~good).alias("rejected"), F.sum("announced").alias("announced"),
        F.sum(F.when(good, F.col("held"))).alias("held"), F.min("meta.source").alias("source"),
        F.min("meta.warning").alias("warning"),
        F.count_if(good & ~F.coalesce(F.col("meta.records_fetched") == 0, F.lit(False))).alias("with_records"),
    )
    document = _tagged("document", announced=F.col("announced"), held=F.col("held"), source=F.col("meta.source"),
                       warning=F.col("meta.warning"))
    records = F.transform(F.coalesce("results", F.array().cast(ArrayType(RECORD))), lambda r: _tagged("record", r=r))
    reject = _tagged("reject", reason=F.col("reason"), text=F.col("text"))
    parsed.select("file", F.explode(F.when(good, F.concat(F.array(document), records)).otherwise(F.array(reject))).alias("x")).select(
        "file", "x.*"
    ).write.parquet(path)
    return {k: v or 0 if k not in ("source", "warning") else v for k, v in seen.get.items()}


def _named(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in files], "file string")


def land_texts(
    spark: SparkSession, texts: DataFrame, whole: bool, on_loss: str = "error", rejects_path: str | None = None, mixed: bool = False
) -> Landed:
    """Parse (file, text) once into scratch. Files of which no line is a
    document, and some line does not even begin one, are read again, each as one
    document (unless ``whole`` texts were given). If ``mixed`` says that there are
    such files, they are looked for first, and their lines are not parsed."""
    if on_loss not in ("error", "warn"):
        raise ValueError(f"on_loss is 'error' or 'warn', not {on_loss!r}")
    schema = StructType([StructField("file", StringType()), *_PARSED.fields])
    known = multiline_files(texts) if mixed and not whole else []
    if known:
        texts = texts.join(F.broadcast(_named(spark, known)), "file", "left_anti")
    path = scratch_path(spark, "landed")
    seen, paths = _write_parsed(texts, path), [path]
    rows = spark.read.schema(schema).parquet(path)
    again = []
    if seen["rejected"] and not whole:
        per_file = rows.groupBy("file").agg(
            F.count_if(F.col("kind") == "document").alias("good"), F.count_if(F.col("kind") == "reject").alias("bad"),
            F.count_if((F.col("kind") == "reject") & F.col("text").rlike(_BEGINS.pattern)).alias("begun"),
        )
        # Where every line begins a document, the lines are documents (cut off).
        again = [r["file"] for r in per_file.filter("good = 0 and bad > 1 and begun < bad").select("file").collect()]
        if again:
            named = _named(spark, again)
            seen["rejected"] -= rows.join(named, "file", "left_semi").filter("kind = 'reject'").count()
            rows = rows.join(named, "file", "left_anti")
    if known or again:
        path = scratch_path(spark, "landed")
        more = _write_parsed(_texts(spark.read, known + again, True), path)
        paths.append(path)
        rows = rows.unionByName(spark.read.schema(schema).parquet(path))
        for k in ("documents", "rejected", "announced", "held", "with_records"):
            seen[k] += more[k]
        for k in ("source", "warning"):
            seen[k] = min((x for x in (seen[k], more[k]) if x is not None), default=None)
    found = Landed(
        rows.filter("kind = 'record'").select(*[F.col(f"r.{f}").alias(f) for f in RECORD_FIELDS]),
        rows.filter("kind = 'reject'").select("file", "reason", "text"),
        int(seen["documents"]), int(seen["rejected"]), int(seen["announced"]), int(seen["held"]), seen["source"], seen["warning"],
        not seen["with_records"] and not seen["rejected"], paths,
    )
    if found.rejected and rejects_path:
        write_table(found.rejects, rejects_path)
    if found.loss:
        if on_loss == "error":
            raise LostRecords(found.loss)
        _LOG.warning("bronze: %s", found.loss)
    return found


def land_bronze(
    spark: SparkSession, path, multiline: bool | None = None, on_loss: str = "error", rejects_path: str | None = None
) -> Landed:
    """Read every document at ``path`` in one parse, whatever its layout:
    records, rejects and counts (:class:`Landed`), in the shared scratch folder.

    If documents could not be read, or hold fewer records than they announce,
    that is an error (:class:`LostRecords`), or with ``on_loss="warn"`` a warning
    and ``Landed.loss``. Rejects are written to ``rejects_path`` either way.
    """
    mixed = False
    if multiline is None:
        seen = _peek_layouts(spark, path)
        multiline, mixed = bool(seen) and all(seen), any(seen)
    return land_texts(spark, _texts(spark.read, path, multiline), multiline, on_loss, rejects_path, mixed)


def bronze_meta(spark: SparkSession, path, multiline: bool | None = None) -> DataFrame:
    """Run metadata of each document."""
    return read_bronze_documents(spark, path, multiline).select("meta.*")


def records_fetched(meta: DataFrame) -> int | None:
    """Total records announced by the documents' metadata; None if a
    document does not say."""
    row = meta.agg(
        F.sum("records_fetched").alias("n"), F.count_if(F.col("records_fetched").isNull()).alias("unknown")
    ).first()
    return None if row["unknown"] else int(row["n"] or 0)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Concatenate pages / partitions of one source by column name; a column
    missing from a batch reads as NULL."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def source_window(
    df: DataFrame,
    date_field: str = "report_date",
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    today: str | None = None,
) -> DataFrame:
    """Date-field range plus row limit, as the source API applies them.

    Bounds are inclusive and may be written with or without dashes; a
    missing start is 1900-01-01 and a missing end is ``today``; with
    neither there is no date filter. The limit keeps the first ``limit``
    records in (date, all fields) order so it is deterministic.
    """
    import datetime as _dt

    out = df
    if start or end:
        lo = dates.to_date_literal(start or "19000101")
        hi = dates.to_date_literal(end or today or _dt.date.today().isoformat())
        out = out.filter(dates.parse_compact_date(date_field).between(lo, hi))
    if limit is not None:
        order = [dates.parse_compact_date(date_field).asc_nulls_last()] + [
            F.col(c).asc_nulls_last() for c in df.columns
        ]
        out = out.orderBy(*order).limit(limit)
    return out


# ------------------------------------------------------------------ writers

#: Records per document written here: a document is one row to its reader.
DOCUMENT_RECORDS = 1000
#: Documents per file written here: a compressed file is read by one task.
FILE_DOCUMENTS = 64


def _doc_json(meta: dict, record_json: list[str]) -> str:
    m = dict(meta)
    m["records_fetched"] = len(record_json)
    return '{"meta":' + json.dumps(m) + ',"results":[' + ",".join(record_json) + "]}"


def _documents(batches, meta: dict):
    for pdf in batches:
        for a in range(0, len(pdf), DOCUMENT_RECORDS):
            yield pd.DataFrame({"value": [_doc_json(meta, pdf["j"].iloc[a : a + DOCUMENT_RECORDS].tolist())]})


def _record_json(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*[F.col(f) for f in RECORD_FIELDS])).alias("j"))


def write_bronze(records: DataFrame, path: str, meta: dict | None = None, mode: str = "overwrite") -> None:
    """Write records as JSON Lines bronze documents of at most
    DOCUMENT_RECORDS records, in gzip files (the text repeats its field names, so
    that a file takes about a sixteenth of it) of at most FILE_DOCUMENTS documents. Without
    any record, one document with the metadata and no results is written, so that the
    run stays on record."""
    spark = records.sparkSession
    ship_package(spark)
    meta = dict(meta or {})
    documents = _record_json(records).mapInPandas(lambda batches: _documents(batches, meta), "value string")
    documents.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)
    if spark.read.text(path).isEmpty():
        spark.createDataFrame([(_doc_json(meta, []),)], "value string").write.mode("append").text(path)


def arrow_file_system(uri: str):
    """(pyarrow file system, path) of a path as Spark qualifies it. Spark's
    names of one store (s3a, s3n; abfss) are turned into pyarrow's."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    scheme, rest = uri.split("://", 1) if "://" in uri else ("", uri)
    scheme = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme)
    return pafs.FileSystem.from_uri(f"{scheme}://{rest}" if scheme else uri)


def _zip_batches(batches, base: str, meta: dict):
    from pyspark import TaskContext

    ctx = TaskContext.get()
    pid, attempt = ctx.partitionId(), ctx.attemptNumber()
    filesystem, root = arrow_file_system(base)
    filesystem.create_dir(root, recursive=True)
    for i, pdf in enumerate(batches):
        if not len(pdf):
            continue
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("documents-0001.json", _doc_json(meta, pdf["j"].tolist()))
        name = f"part-{pid:05d}-{i:05d}.zip"
        # Write under an attempt-specific name, then move into place: a
        # retried or speculative attempt never exposes a partial file.
        tmp = f"{root}/_tmp-{name}-{attempt}"
        with filesystem.open_output_stream(tmp) as out:
            out.write(buf.getvalue())
        filesystem.move(tmp, f"{root}/{name}")
        yield pd.DataFrame({"path": [f"{base}/{name}"], "records": [len(pdf)]})


def write_bronze_archives(records: DataFrame, directory: str, meta: dict | None = None) -> DataFrame:
    """Write records as ZIP archives (one ``.json`` document each), one per
    Arrow batch, named by partition and batch so a retried task rewrites
    the same files. Returns (path, records) per archive - lazily: run an
    action on it to write."""
    spark = records.sparkSession
    ship_package(spark)
    meta = dict(meta or {})
    base = qualified_path(spark, directory).rstrip("/")
    return _record_json(records).mapInPandas(lambda batches: _zip_batches(batches, base, meta), "path string, records long")


def _json_values(stream, chunk: int = 1 << 20):
    """(key, text of the value) of a JSON object read from a text stream in
    chunks; the elements of an array come one by one. Memory is bounded by
    the longest element, not by the document."""
    decoder = json.JSONDecoder()
    text, at, ended = "", 0, False

    def more() -> bool:
        nonlocal text, at, ended
        piece = stream.read(chunk)
        ended = not piece
        text, at = text[at:] + piece, 0
        return not ended

    def skip() -> str:
        nonlocal at
        while True:
            while at < len(text) and text[at] in " \t\r\n\ufeff":
                at += 1
            if at < len(text):
                return text[at]
            if not more():
                raise ValueError("the document ends inside a value")

    def value():
        """The next complete value as text."""
        nonlocal at
        while True:
            skip()
            try:
                _, end = decoder.raw_decode(text, at)
            except ValueError:
                if not more():
                    raise
                continue
            if not ended and (end == len(text) or text[end] not in " \t\r\n,:]}"):  # a number may go on
                more()
                continue
            out = text[at:end]
            at = end
            return out

    if skip() != "{":
        raise ValueError("a bronze document is a JSON object")
    at += 1
    while skip() != "}":
        if text[at] == ",":
            at += 1
            skip()
        key = json.loads(value())
        if skip() != ":":
            raise ValueError("a key without a value")
        at += 1
        if skip() == "[":
            at += 1
            while skip() != "]":
                if text[at] == ",":
                    at += 1
                    continue
                yield key, value()
            at += 1
        else:
            yield key, value()


def _unzip_batches(batches):
    for pdf in batches:
        for path in pdf["path"]:
            filesystem, name = arrow_file_system(path)
            with filesystem.open_input_file(name) as raw, zipfile.ZipFile(raw) as zf:
                members = [n for n in zf.namelist() if n.endswith(".json")]
                if not members:
                    raise RuntimeError(f"No JSON file found inside {path}")
                meta, held, total = "null", [], 0
                with io.TextIOWrapper(zf.open(members[0]), encoding="utf-8") as stream:
                    for key, value in _json_values(stream):
                        if key == "meta":
                            meta = value
                        elif key == "results":
                            held.append(" ".join(value.splitlines()))
                            if len(held) == DOCUMENT_RECORDS:
                                yield pd.DataFrame({"value": ['{"results":[' + ",".join(held) + "]}"]})
                                held, total = [], total + DOCUMENT_RECORDS
                # The last line carries the metadata (a key may follow the
                # results), and announces what the lines before do not hold.
                rest = json.loads(meta)
                if isinstance(rest, dict) and isinstance(rest.get("records_fetched"), int) and rest["records_fetched"]:
                    rest["records_fetched"] -= total
                rest = json.dumps(rest)
                yield pd.DataFrame({"value": ['{"meta":' + rest + ',"results":[' + ",".join(held) + "]}"]})


def unpack_archives(spark: SparkSession, directory: str) -> str:
    """Unpack every ZIP under ``directory`` (the first ``.json`` member of
    each) into JSON Lines documents in the shared scratch folder; returns
    that folder. An empty listing, or an archive without a JSON member, is
    an error.

    Tasks get *paths* and stream: neither an archive nor a document is ever
    held whole, and the result is split by lines, so a single huge export
    is read by many tasks afterwards.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(directory)
    names = files.select("path")  # the content column is pruned: nothing is read here
    n = names.count()
    if not n:
        raise RuntimeError(f"No archives found under {directory}")
    out_dir = scratch_path(spark, "unzipped")
    spread = names.repartition(min(n, 10_000))
    spread.mapInPandas(_unzip_batches, "value string").write.text(out_dir)
    return out_dir


def read_bronze_archives(spark: SparkSession, directory: str) -> DataFrame:
    """All ``results`` of every ZIP under ``directory``."""
    return read_bronze(spark, unpack_archives(spark, directory))
