"""File sources: article CSV (S1), observation CSV (S2), re-read results
and landed RSS/XML feeds with whole-file rejection (S3-S5).

Every reader adds ``_source_file`` and ``_pos``: the input position used
wherever "first" or "last" must be deterministic (``_pos`` orders rows
within a file; ``(_source_file, _pos)`` orders them across files).
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Sequence
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from quire.functions.scalars import PANDAS_NA_TOKENS, na_to_null

ARTICLE_CSV_SCHEMA = ("title string, author_id string, last_updated string, link string, "
                      "category string")
OCCUPANCY_SCHEMA = ("geo string, YEAR int, PRISONERS_NUM double, CAPACITY_NUM double, "
                    "OCC_ABS double, PRISONERS_100K double, CAPACITY_100K double, "
                    "OCC_PER_100K double")
# Feed item layout as landed RSS 2.0 XML (one row per <item>).
FEED_ITEM_SCHEMA = ("title string, link string, guid struct<_VALUE:string,_isPermaLink:string>, "
                    "category array<string>, `dc:creator` string, pubDate string, "
                    "`atom:updated` string, description string, _corrupt_record string")
# Atom entry layout (one row per <entry>).
ATOM_ENTRY_SCHEMA = ("title string, link array<struct<_href:string,_rel:string>>, id string, "
                     "category array<struct<_term:string>>, author array<struct<name:string>>, "
                     "published string, updated string, summary string, content string, "
                     "_corrupt_record string")
# Root elements of RSS 2.0, RSS 1.0 and Atom, without a prefix.
FEED_ROOTS = ("rss", "RDF", "feed")
# Encodings that the markup parser reads itself; the others are decoded for it.
NATIVE_ENCODINGS = ("utf-8", "utf8", "us-ascii", "ascii", "iso-8859-1", "utf-16")
NOT_CLOSED = "root element not closed"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def with_position(df: DataFrame) -> DataFrame:
    """``_source_file`` and a per-file increasing ``_pos`` (block start of
    the split, then row order inside the task)."""
    return (df.withColumn("_source_file", F.col("_metadata.file_path"))
              .withColumn("_pos", F.struct(F.col("_metadata.file_block_start").alias("block"),
                                           F.monotonically_increasing_id().alias("row"))))


def read_csv(spark: SparkSession, paths, schema: str | StructType | None = None,
             null_tokens: Sequence[str] = PANDAS_NA_TOKENS, multiline: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with a header; quoted fields may hold commas, doubled quotes and
    (``multiline``) newlines.  Without a schema every column is text.  The
    pandas missing-value tokens become NULL (Q9).  ``multiline`` makes each
    file one task; turn it off for large exports without quoted newlines so
    files split."""
    r = (spark.read.option("header", True).option("sep", sep).option("quote", '"')
         .option("escape", '"').option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    df = with_position(r.csv(_paths(paths)))
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType) and not f.name.startswith("_"):
            out.append(na_to_null(F.col(f"`{f.name}`"), null_tokens).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def read_article_csv(spark: SparkSession, paths, **kw) -> DataFrame:
    """Article export (title, author_id, last_updated, link, category)."""
    return read_csv(spark, paths, ARTICLE_CSV_SCHEMA, **kw)


def read_observations_csv(spark: SparkSession, paths, **kw) -> DataFrame:
    """Long statistics export; all columns kept, as text."""
    return read_csv(spark, paths, None, **kw)


def read_occupancy(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read a saved occupancy table with its declared schema."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(OCCUPANCY_SCHEMA).csv(path)
    return spark.read.parquet(path)


def _records(spark: SparkSession, paths, row_tag: str, schema: str) -> DataFrame:
    df = (spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .schema(schema).load(_paths(paths)))
    return with_position(df).withColumn(
        "feed", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))


def read_feed_items(spark: SparkSession, paths) -> DataFrame:
    """S3 + S5: the RSS items and Atom entries of many landed feed files, in
    the items' layout; ``feed`` is the file name without extension."""
    rss = _records(spark, paths, "item", FEED_ITEM_SCHEMA)
    atom = _records(spark, paths, "entry", ATOM_ENTRY_SCHEMA)
    own = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    entries = atom.select(
        "title", F.get(own, F.lit(0))["_href"].alias("link"),
        F.struct(F.col("id").alias("_VALUE"), F.lit(None).cast("string").alias("_isPermaLink")).alias("guid"),
        F.transform("category", lambda c: c["_term"]).alias("category"),
        F.transform("author", lambda a: a["name"]).alias("creators"),
        F.col("published").alias("pubDate"), F.col("updated").alias("atom:updated"),
        F.coalesce("summary", "content").alias("description"),
        "_corrupt_record", "_source_file", "_pos", "feed")
    creators = F.when(F.col("`dc:creator`").isNotNull(), F.array("`dc:creator`"))
    items = rss.withColumn("creators", creators).drop("dc:creator")
    return items.unionByName(entries)


class _Markup:
    """Well-formedness of one file, fed in pieces to a streaming parser:
    ``root`` (the first element) and ``error`` (NULL if nothing is wrong)."""

    def __init__(self):
        self.root = self.error = self._parser = self._decode = None
        self._head = b""

    def _open(self) -> None:
        # The item readers can't read UTF-16: it must not count as intact.
        if self._head.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)) or b"\0" in self._head:
            raise ValueError("not in a superset of ASCII")
        name = re.match(rb"<\?xml[^>]*?encoding\s*=\s*[\"']([\w.:-]+)", self._head)
        if name and (name := name[1].decode()).lower() not in NATIVE_ENCODINGS and codecs.lookup(name)._is_text_encoding:
            self._decode = codecs.getincrementaldecoder(name)("replace").decode
        self._parser = expat.ParserCreate()
        self._parser.StartElementHandler = self._first

    def _first(self, name: str, _) -> None:
        self.root = name
        self._parser.StartElementHandler = None

    def feed(self, data: bytes, last: bool = False) -> None:
        if self.error:
            return
        try:
            if self._parser is None:
                self._head = (self._head + data).removeprefix(codecs.BOM_UTF8)
                if not last and b">" not in self._head and len(self._head) < 4096:
                    return
                self._open()
                data = self._head
            self._parser.Parse(self._decode(data, last) if self._decode else data, last)
        except expat.ExpatError as e:
            self.error = NOT_CLOSED if self.root and e.code == expat.errors.codes[expat.errors.XML_ERROR_NO_ELEMENTS] else str(e)
        except (LookupError, ValueError) as e:
            self.error = str(e)


def _judge(batches):
    """(_source_file, root, error) of files whose lines come in order."""
    import pyarrow as pa

    def row(name, markup):
        markup.feed(b"", True)
        return pa.RecordBatch.from_pylist([{"_source_file": name, "root": markup.root, "error": markup.error}],
                                          pa.schema([(c, pa.string()) for c in ("_source_file", "root", "error")]))
    name = markup = None
    for batch in batches:
        for f, line in zip(batch.column("_source_file"), batch.column("line"), strict=True):
            if (f := f.as_py()) != name:
                if markup is not None:
                    yield row(name, markup)
                name, markup = f, _Markup()
                markup.feed(line.as_py())
            else:
                markup.feed(b"\n" + line.as_py())
    if markup is not None:
        yield row(name, markup)


def empty_files(spark: SparkSession, paths) -> list[str]:
    """The files of no bytes among the paths (files, folders or globs)."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    paths = _paths(paths)
    for path in [paths] if isinstance(paths, str) else paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        for found in fs.globStatus(p) or []:
            for f in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
                if f.isFile() and f.getLen() == 0 and not str(f.getPath().getName()).startswith(("_", ".")):
                    out.append(str(f.getPath().toUri().toString()))
    return out


def feed_files(spark: SparkSession, paths) -> DataFrame:
    """One row for each landed file: its first element, the parser's ``error``
    (NULL if the whole file is well-formed) and what else is wrong with the
    file (``fault``: NULL if nothing is).  The lines are read in splits; each
    file's are then parsed in order by one task, as a stream, so that no file
    has to fit in memory.  Files of no bytes, which are in no Spark scan, are
    listed from the file system."""
    listed = spark.read.format("binaryFile").load(_paths(paths)).select(
        F.col("_metadata.file_path").alias("_source_file"))
    listed = listed.unionByName(spark.createDataFrame([(f,) for f in empty_files(spark, paths)], "_source_file string")).distinct()
    lines = with_position(spark.read.option("lineSep", "\n").text(_paths(paths)))
    ends = (lines.select("_source_file", "_pos", F.col("value").cast("binary").alias("line"))
            .repartition("_source_file").sortWithinPartitions("_source_file", "_pos").select("_source_file", "line")
            .mapInArrow(_judge, "_source_file string, root string, error string"))
    known = F.regexp_replace("root", r"^.*:", "").isin(*FEED_ROOTS)
    return listed.join(ends, "_source_file", "left").withColumn(
        "fault", F.when(F.col("root").isNull(), F.lit("no element"))
        .when(~known, F.concat(F.lit("root element "), F.col("root")))
        .when(F.col("error") == NOT_CLOSED, F.col("error")))


def rejected_files(items: DataFrame, files: DataFrame) -> DataFrame:
    """One row for each file with a fault, with a record that can't be parsed or not well-formed."""
    # (a data column is referenced too: Spark refuses scans that read only
    # the corrupt-record column)
    touch = F.length(F.coalesce(F.col("title"), F.lit(""))) >= 0
    corrupt = items.filter(F.col("_corrupt_record").isNotNull() & touch) \
                   .groupBy("_source_file").agg(F.count(F.lit(1)).alias("corrupt_records"))
    records = F.coalesce(F.col("corrupt_records"), F.lit(0))
    reason = F.coalesce(F.col("fault"), F.when(records > 0, F.lit("records not parsed")),
                        F.concat(F.lit("not well-formed: "), F.col("error")))
    return files.join(corrupt, "_source_file", "left").select(
        "_source_file", reason.alias("reason"), records.alias("corrupt_records")).filter("reason IS NOT NULL")


def intact(items: DataFrame, rejected: DataFrame) -> DataFrame:
    """A rejected file contributes no rows at all.  ``rejected`` has one
    row per file, so the anti-join stays small; AQE broadcasts it when its
    measured size allows."""
    return items.join(rejected.select("_source_file"), "_source_file", "left_anti").drop("_corrupt_record")


def feed_items_to_entries(items: DataFrame) -> DataFrame:
    """XML items -> feed-entry shape (the fields a feed parser exposes):
    title/summary details as structs, tags and authors as arrays."""
    tags = F.when(F.size(F.col("category")) > 0,
                  F.transform(F.col("category"), lambda c: F.struct(c.alias("term"))))
    authors = F.when(F.size(F.col("creators")) > 0,
                     F.transform(F.col("creators"), lambda c: F.struct(c.alias("name"))))
    return items.select(
        "feed", F.col("_pos").alias("pos"), "_source_file",
        F.col("title"),
        F.when(F.col("title").isNotNull(),
               F.struct(F.lit("text/plain").alias("type"), F.col("title").alias("value"))
               ).alias("title_detail"),
        F.col("description").alias("summary"),
        F.when(F.col("description").isNotNull(),
               F.struct(F.lit("text/html").alias("type"), F.col("description").alias("value"))
               ).alias("summary_detail"),
        F.col("link"),
        F.coalesce(F.col("guid._VALUE"), F.col("link")).alias("id"),
        F.col("pubDate").alias("published"),
        F.lit(None).cast("string").alias("published_parsed"),
        F.col("`atom:updated`").alias("updated"),
        tags.alias("tags"), authors.alias("authors"))


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once to ``path`` (a folder in the shared workspace) and
    read it back: later uses scan columnar Parquet instead of re-parsing the
    source, and the lineage is cut, so a lost executor re-reads the copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_feeds(spark: SparkSession, paths, work_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries of intact feed files, rejected files with the reason).
    With ``work_dir`` the XML is parsed once into a Parquet copy there (and
    the rejected files beside it); without it both are computed from the XML."""
    items, files = read_feed_items(spark, paths), feed_files(spark, paths)
    if work_dir is not None:
        items = materialize(items, work_dir)
        rejected = materialize(rejected_files(items, files), f"{work_dir.rstrip('/')}_rejected")
    else:
        rejected = rejected_files(items, files)
    return feed_items_to_entries(intact(items, rejected)), rejected
