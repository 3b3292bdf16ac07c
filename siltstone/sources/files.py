"""Readers and writers. Schemas are given, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.aggregates import keep_first
from siltstone.sources.snapshots import SnapshotStore

COMPANY = "ticker string, market string, source string, form_types string, years string, notes string"
BLOCK = "schema_version string, source_path string, ticker string, form string, year int, accno string, doc_date string, css_path string, language string, tokens int, created_at string, id string, section string, heading string, statement_hint string, text string, tag string, idx_source int, chunk_tok_start int, chunk_tok_end int, part string, item string, page_no int, page_anchor string, xpath string"
#: Routes a file name to its record type, first match wins.
ROUTES = [("fact", r"fact\.jsonl$"), ("text", r"(text|text_corpus)\.jsonl$"), ("calculation_edge", r"calculation_edges"), ("definition_arc", r"definition_arcs"), ("label_wide", r"labels_wide"), ("label_best", r"labels_best|labels\.jsonl$"), ("label_long", r"labels")]


def companies(spark: SparkSession, path: str) -> DataFrame:
    """EDGAR companies of the US market, a row for each form and year."""
    raw = spark.read.csv(path, header=True, schema=COMPANY)
    mine = raw.where((F.upper("source") == "EDGAR") & (F.upper("market") == "US"))
    parts = lambda c: F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    one = mine.select("ticker", F.explode(parts("form_types")).alias("form"), F.filter(parts("years"), lambda y: y.rlike(r"^\d+$")).alias("y"))
    return one.select("ticker", "form", F.explode("y").alias("year")).withColumn("year", F.col("year").cast("int"))


def jsonl(spark: SparkSession, path: str, schema: str | T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """PERMISSIVE keeps bad lines in _corrupt_record, DROPMALFORMED skips them, FAILFAST stops."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if mode == "PERMISSIVE" and "_corrupt_record" not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("mode", mode).json(path)


def record_type(path: Column) -> Column:
    """1.3: record type of a file by its name."""
    out = F.lit(None).cast("string")
    for name, rule in reversed(ROUTES):
        out = F.when(path.rlike(rule), name).otherwise(out)
    return out


def texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, whole text and whether it looks like XML."""
    raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return raw.withColumn("is_xml", F.substring("text", 1, 200).rlike(r"(?i)<\?xml") & ~F.substring("text", 1, 200).rlike(r"(?i)<html"))


def filing_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, folder, name, length and time of the files below a path; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return f.withColumns({"name": F.element_at(F.split("path", "/"), -1), "folder": F.regexp_replace("path", "/[^/]*$", "")})


def primary_document(files: DataFrame, by: str, name: str, size: str) -> DataFrame:
    """Of each folder the largest HTML that is no details page, then details, submission, HTML, text."""
    n = F.lower(name)
    html = n.rlike(r"\.html?$")
    priority = F.when(html & ~n.contains("filing-details"), 0).when(html & n.contains("filing-details"), 1).when(n.contains("full-submission"), 2).when(html, 3).when(n.endswith(".txt"), 4)
    return keep_first(files.withColumn("priority", priority).where("priority IS NOT NULL"), [by], ["priority", F.desc(size), name])


def xml_payloads(files: DataFrame, name: str) -> DataFrame:
    """XML files by kind: label, calculation, definition, presentation, schema or instance; summaries are left out."""
    n = F.lower(name)
    kind = F.when(n.rlike(r"_lab\.xml$"), "label").when(n.rlike(r"_cal\.xml$"), "calculation").when(n.rlike(r"_def\.xml$"), "definition").when(n.rlike(r"_pre\.xml$"), "presentation").when(n.endswith(".xsd"), "schema").otherwise("instance")
    return files.where(n.rlike(r"\.(xml|xbrl|xsd)$") & ~n.contains("filingsummary")).withColumn("kind", kind)


def filing_date(metadata: Column, text: Column, accno: Column) -> Column:
    """Year of the metadata's date, of a date in the text, or of the accession; else 0000."""
    year = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d{4})", 1), F.lit(""))
    short = F.regexp_extract(F.coalesce(accno, F.lit("")), r"^\d{10}-(\d{2})-\d{6}$", 1)
    of_accno = F.when(short != "", F.concat(F.when(short.cast("int") < 70, "20").otherwise("19"), short))
    return F.coalesce(year(F.get_json_object(metadata, "$.filing_date")), year(F.regexp_extract(text, r"(?i)Filing\s*Date\D{0,20}(\d{4}-?\d{2}-?\d{2})", 1)), of_accno, F.lit("0000"))


def standard_name(ticker: Column, year: Column, form: Column, accno: Column, ext: Column) -> Column:
    """S10."""
    return F.concat(F.lit("US_"), F.upper(ticker), F.lit("_"), year.cast("string"), F.lit("_"), F.upper(form), F.lit("_"), accno, F.lit("."), F.lower(ext))


def cik(path: Column, html: Column, mapped: Column, accno: Column, agents: list[str]) -> Column:
    """From path, page, ticker map or accession prefix, without filing agents."""
    pad = lambda c: F.when(c != "", F.lpad(c, 10, "0"))
    allowed = lambda c: F.when(~c.isin(agents), c) if agents else c
    return F.coalesce(allowed(pad(F.regexp_extract(F.coalesce(path, F.lit("")), r"/edgar/data/(\d+)/", 1))), allowed(pad(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)CIK\D{0,10}(\d{4,10})", 1))), mapped, allowed(pad(F.regexp_extract(F.coalesce(accno, F.lit("")), r"^(\d{10})-", 1))))


def unprocessed(inputs: DataFrame, manifest: DataFrame, key: str, modified: str | None = None) -> DataFrame:
    """Inputs that the manifest lacks, or has only as older ones."""
    if not modified:
        return inputs.join(manifest, key, "left_anti")
    done = manifest.groupBy(key).agg(F.max(modified).alias("_done"))
    return inputs.join(done, key, "left").where(F.col("_done").isNull() | (F.col(modified) > F.col("_done"))).drop("_done")


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Parquet, csv or jsonl, partitioned by columns; only partitions that are written are replaced."""
    w = df.write.mode(mode)
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        nested = {f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)}
        w2 = df.withColumns(nested).write.mode(mode)
        (w2.partitionBy(*by) if by else w2).option("header", True).csv(path)
    elif fmt == "jsonl":
        w.json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


#: The relational store of facts: tables and their columns.
STORE = {
    "facts": "filing_id string, qname string, value_raw string, is_numeric boolean, decimals string, unit_id string, context_id string, label_role string, footnote_refs string, doc_order long",
    "contexts": "filing_id string, context_id string, entity string, period_start date, period_end date, period_instant date, is_forever boolean, dimensions string",
    "units": "filing_id string, unit_id string, measures string",
    "labels": "filing_id string, qname string, role string, lang string, text string",
    "calc_edges": "filing_id string, from_qname string, to_qname string, weight double, ord double",
    "pre_edges": "filing_id string, from_qname string, to_qname string, ord double, preferred_label string",
    "def_edges": "filing_id string, from_qname string, to_qname string, arcrole string, ord double",
}


def save_store(tables: dict[str, DataFrame], path: str) -> int:
    """All tables in one commit, by filing; loading a filing again replaces it in all of them. Returns the version.

    A filing that is in any of these tables is replaced in each of them: what it no longer
    has goes. Columns beyond those of STORE are added; nested ones are stored as JSON.
    """
    for name in tables:
        if name not in STORE:
            raise ValueError(f"unknown table {name!r}")
    spark = next(iter(tables.values())).sparkSession
    store = SnapshotStore(spark, path)
    with store.transaction() as tx:
        for name, schema in STORE.items():
            tx.declare(name, T.StructType.fromDDL(schema), "filing_id")
        # partitions written: at most one for each filing that is loaded
        written = {name: set(tx.replace(name, as_stored(df, STORE[name]), "filing_id")) for name, df in tables.items()}
        loaded = set().union(*written.values())
        for name, own in written.items():
            tx.drop(name, loaded - own)
    return store.version()


def as_stored(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a table of the store, null where df lacks them, and df's others; nested ones as JSON."""
    want = T.StructType.fromDDL(schema)
    out = df.withColumns({f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)})
    known = [(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
    return out.select(*known, *(c for c in df.columns if c not in want.names))


def load_store(spark: SparkSession, path: str, filings: list[str] | None = None, version: int | None = None) -> dict[str, DataFrame]:
    """The tables as of one version, the last by default; with filings only their files are opened."""
    store = SnapshotStore(spark, path)
    version = store.version() if version is None else version
    return {name: store.read(name, filings, version) for name in STORE}


def save_index(index: DataFrame, path: str) -> None:
    """Vectors with ids and meta, and a row about the build, in one commit."""
    about = index.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"), F.count_distinct("id").alias("ids"))
    with SnapshotStore(index.sparkSession, path).transaction() as tx:
        tx.replace("index", index)
        tx.replace("build_info", about)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """Fails if the count differs from that of the build; Parquet's footers tell it, no vector is read."""
    store = SnapshotStore(spark, path)
    index, about = store.read("index"), store.read("build_info").first()
    if (n := index.select().count()) != about["n"]:
        raise ValueError(f"index has {n} rows, its build wrote {about['n']}")
    return index


def flatten_meta(df: DataFrame, meta: str = "meta") -> DataFrame:
    """Fields of meta beside the outer ones, which win."""
    inner = df.schema[meta].dataType.fieldNames()
    return df.withColumns({c: F.coalesce(F.col(c), F.col(f"{meta}.{c}")) if c in df.columns else F.col(f"{meta}.{c}") for c in inner}).drop(meta)


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """S29."""
    write(nodes, f"{path}/nodes", "jsonl")
    write(edges, f"{path}/edges", "jsonl")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    nodes = jsonl(spark, f"{path}/nodes", "node_id string, label string, name string, mention_count long, tickers array<string>, years array<int>", "FAILFAST")
    return nodes, jsonl(spark, f"{path}/edges", "source string, target string, weight long, relation string", "FAILFAST")


TIMELINES = "label string, normalized string, total long, entries array<struct<year:int,mentions:long>>"


def save_timelines(totals: DataFrame, path: str) -> None:
    """S30."""
    write(totals, path, "jsonl")


def load_timelines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMELINES).option("mode", "FAILFAST").json(path)


def mapping_surfaces(spark: SparkSession, labels: dict[str, list[str]]) -> DataFrame:
    """Concept and surface of a mapping, as it is read from YAML."""
    return spark.createDataFrame([(c, s) for c, forms in sorted(labels.items()) for s in forms], "concept string, surface string")
