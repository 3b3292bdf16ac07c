"""Command line: the stages, one by one (V07) or in a row (V06), questions over an index, both legs alone (V11), and facts to a store."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import facts as Fx
from siltstone.operators import search, xml_files
from siltstone.plans import runner
from siltstone.session import session
from siltstone.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="stages in a row, from pages or rows in Parquet")
    run.add_argument("--stages", default="all")
    for name in ("run", *runner.STAGES):
        one = run if name == "run" else sub.add_parser(name, help=f"the stage {name}")
        one.add_argument("--input", required=True)
        one.add_argument("--output", required=True)
        one.add_argument("--format", default="parquet", choices=["parquet", "csv", "jsonl"])
    ask = sub.add_parser("query", help="one question, or a file of them as JSON lines with qid and query")
    ask.add_argument("--index", required=True)
    ask.add_argument("--question")
    ask.add_argument("--questions")
    ask.add_argument("--topk", type=int, default=8)
    ask.add_argument("--candidates", type=int, default=200)
    ask.add_argument("--ce-candidates", type=int, default=256)
    ask.add_argument("--ce-weight", type=float, default=0.5)
    for name in ("bm25", "dense"):
        leg = sub.add_parser(name, help=f"the {name} leg alone")
        leg.add_argument("--index", required=True)
        leg.add_argument("--question", required=True)
        leg.add_argument("--topk", type=int, default=8)
    ingest = sub.add_parser("ingest", help="instances and linkbases in XML to the store of facts")
    ingest.add_argument("--input", required=True)
    ingest.add_argument("--store", required=True)
    ingest.add_argument("--rejects", help="where to write the files that cannot be read, with the error, as JSON lines")
    return p


def questions(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """qid and query."""
    if getattr(args, "questions", None):
        return files.jsonl(spark, args.questions, "qid string, query string", "FAILFAST")
    if not args.question:
        raise SystemExit("give --question or --questions")
    return spark.createDataFrame([("1", args.question)], "qid string, query string")


def answer(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Hits of the questions with a line to read."""
    index, asked = files.load_index(spark, args.index), questions(spark, args)
    if args.command == "bm25":
        hits = search.bm25(index, asked, "id", "content", "qid", "query", args.topk)
    elif args.command == "dense":
        hits = search.dense(index, search.embed_texts(asked, "query"), "id", "embedding", "qid", "embedding", args.topk)
    else:
        hits = runner.search_index(index, asked, k=args.topk, candidates=args.candidates, ce_candidates=args.ce_candidates, ce_weight=args.ce_weight).withColumnRenamed("final_score", "score")
    shown = hits.join(index.select(F.col("id").alias("doc"), "heading", "content"), "doc")
    return search.format_hits(shown, "rank", "score", "doc", "heading", "content").select("qid", "rank", "doc", "score", "line").orderBy("qid", "rank")


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Instances and linkbases to all tables of the store, in one commit.

    A filing goes by its files' name, without the ending of a linkbase (_lab, _cal, _pre, _def).
    """
    raw = files.texts(spark, args.input).withColumn("filing_id", F.regexp_extract("path", r"([^/]+?)(?:_(?:lab|cal|pre|def))?(?:\.\w+)?$", 1))
    rows = Fx.xbrl_facts(raw, "filing_id", "text")
    facts = rows.select("filing_id", "qname", F.col("value").alias("value_raw"), F.col("value").try_cast("double").isNotNull().alias("is_numeric"), "decimals", "unit_id", "context_id", F.lit(None).cast("string").alias("label_role"), F.lit(None).cast("string").alias("footnote_refs"), F.col("ord").cast("long").alias("doc_order"))
    contexts = rows.select("filing_id", "context_id", "entity", F.to_date("period_start").alias("period_start"), F.to_date("period_end").alias("period_end"), F.to_date("instant").alias("period_instant"), F.lit(False).alias("is_forever"), F.to_json("dimensions").alias("dimensions")).dropDuplicates(["filing_id", "context_id"])
    units = rows.where("unit_id IS NOT NULL").select("filing_id", "unit_id", F.to_json(F.array("unit")).alias("measures")).dropDuplicates(["filing_id", "unit_id"])
    arcs = Fx.xbrl_arcs(raw, "filing_id", "text")
    edges = lambda kind, *columns: arcs.where(F.col("kind") == kind).select("filing_id", F.col("from_concept").alias("from_qname"), F.col("to_concept").alias("to_qname"), *columns).dropDuplicates()
    labels = arcs.where("kind = 'label'").select("filing_id", F.col("from_concept").alias("qname"), "role", "lang", "text").dropDuplicates()
    tables = {"facts": facts, "contexts": contexts, "units": units, "labels": labels, "calc_edges": edges("calculation", "weight", "ord"), "pre_edges": edges("presentation", "ord", "preferred_label"), "def_edges": edges("definition", "arcrole", "ord")}
    files.save_store(tables, args.store)
    if args.rejects:
        files.write(xml_files.unreadable(raw, "path", "text"), args.rejects, "jsonl")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or session()
    if args.command in ("query", "bm25", "dense"):
        for r in answer(spark, args).toLocalIterator():  # topk lines a question
            print(json.dumps({"qid": r["qid"], "line": r["line"]}, ensure_ascii=False) if getattr(args, "questions", None) else r["line"])
    elif args.command == "ingest":
        ingest(spark, args)
    else:
        out = runner.run(spark.read.parquet(args.input), args.stages if args.command == "run" else args.command)
        if args.output and "embedding" in out.columns and args.format == "parquet":
            files.save_index(out, args.output)
        else:
            files.write(out, args.output, args.format)


if __name__ == "__main__":
    main()
