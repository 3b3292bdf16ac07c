"""The corpus stages and the question path, as compositions of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import normalize_entity, path_priority, snippet, stable_id, title_from_meta
from siltstone.operators import chunking, entities, evidence, html_blocks, search
from siltstone.operators.aggregates import resolve_conflicts
from siltstone.operators.joins import valid_citations
from siltstone.operators.question_sets import hybrid_of_many
from siltstone.session import written

STAGES = ["parse", "clean", "ner", "chunk", "index"]


def parse_stage_list(text: str) -> list[str]:
    """A list with commas, or all; in the order of STAGES, unknown names are refused."""
    wanted = STAGES if text.strip() == "all" else [s.strip() for s in text.split(",") if s.strip()]
    if unknown := set(wanted) - set(STAGES):
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    return [s for s in STAGES if s in wanted]


def parse(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """doc, line, text, heading of the blocks of pages."""
    b = html_blocks.html_blocks(pages, page_id, html)
    return b.select("doc", F.col("ord").alias("line"), "text", F.col("heading").alias("heading_src"))


def clean(lines: DataFrame) -> DataFrame:
    return chunking.clean_rows(lines, "doc", "line", "text")


def ner(rows: DataFrame, recognizer: entities.Recognizer = entities.rule_recognizer) -> DataFrame:
    return entities.extract_entities(rows, "text", recognizer)


def chunk(rows: DataFrame) -> DataFrame:
    ordered = rows.withColumn("_line", F.struct("line", "sentence_no", "piece_no"))
    return chunking.chunk_documents(ordered, "doc", "_line", "heading", "text")


def build_index(chunks: DataFrame, size: int = 64, path: str | None = None, modified: str | None = None) -> DataFrame:
    """One row an id (A23), with title, snippet, 63-bit id, text hash and embedding. A title that chunks bring, or that A23 filled from the same text, stays; else it is made from the heading."""
    rows = chunks.withColumns({"text_hash": F.sha2("content", 256), "_path": F.col(path) if path else F.lit(""), "_time": F.col(modified) if modified else F.lit(0), "_order": F.xxhash64("content")})
    one = resolve_conflicts(rows, "id", path_priority("_path"), "_time", "_order").drop("_path", "_time", "_order")
    none = F.lit(None).cast("string")
    given = F.nullif(F.trim("title"), F.lit("")) if "title" in one.columns else none
    titled = one.withColumns({"title": F.coalesce(given, title_from_meta(F.col("heading"), none, none, F.lit(None))), "snippet": snippet("content"), "id64": stable_id("id")})
    return search.embed_texts(titled.withColumn("_t", F.concat_ws("\n\n", "title", "content")), "_t", size).drop("_t")


HANDLERS: dict[str, Callable[[DataFrame], DataFrame]] = {"parse": parse, "clean": clean, "ner": ner, "chunk": chunk, "index": build_index}


def run(source: DataFrame, stages: str = "all") -> DataFrame:
    """Stages one after the other, lazily; the first takes the source."""
    out = source
    for name in parse_stage_list(stages):
        out = HANDLERS[name](out)
    return out


#: How a question names a date.
MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
YEAR = r"(?:19|20)\d{2}"
DATE = rf"(?i)\b(?:\d{{4}}-\d{{2}}-\d{{2}}|{MONTH}\s+\d{{1,2}},?\s+{YEAR}|{MONTH}\s+{YEAR}|(?:Q[1-4]|(?:first|second|third|fourth) quarter)(?:\s+of)?(?:\s+(?:fiscal|FY))?\s+{YEAR}|(?:fiscal(?:\s+year)?|FY)\s*{YEAR}|{YEAR})\b"


def dates(question: str) -> Column:
    """Dates, quarters and years of a question as it writes them, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(question), F.lit("")), F.lit(DATE), F.lit(0)))


def query_entities(questions: DataFrame, query_id: str, query: str, recognizer: entities.Recognizer = entities.rule_recognizer) -> DataFrame:
    """Orgs, gpes, tickers, fin_metrics and dates of each question."""
    found = entities.extract_entities(questions, query, recognizer)
    of = lambda label: F.transform(F.filter("entities", lambda e: e["label"] == label), lambda e: e["normalized"])
    return found.select(query_id, of("ORG").alias("orgs"), of("GPE").alias("gpes"), of("TICKER").alias("tickers"), of("FIN_METRIC").alias("fin_metrics"), dates(query).alias("dates"))


def search_index(index: DataFrame, questions: DataFrame, query_id: str = "qid", query: str = "query", k: int = 8, candidates: int = 200, ce_candidates: int = 256, ce_weight: float = 0.5, size: int = 64, held: int = search.HELD) -> DataFrame:
    """Both legs for a table of questions, fused and reranked; qid, doc, rank, final_score. The index is made once, for all that read it.

    Questions with more than `held` hits of a leg in all are answered from the lists that they share.
    """
    index = written(index.select("id", "content", "embedding"), "index")
    asked = search.embed_texts(questions, query, size)
    if questions.count() * candidates > held:
        return hybrid_of_many(index, asked, "id", "content", "embedding", query_id, query, "embedding", candidates, ce_candidates, k, ce_weight=ce_weight)
    words = search.bm25(index, questions, "id", "content", query_id, query, candidates)
    near = search.dense(index, asked, "id", "embedding", query_id, "embedding", candidates)
    return search.hybrid(words, near, index, questions, "id", "content", query_id, query, ce_candidates, k, ce_weight=ce_weight)


def evidence_for(index: DataFrame, hits: DataFrame, budget: int = 2400, k: int = 8) -> DataFrame:
    """Packed evidence of the hits of each question."""
    texts = index.select(F.col("id").alias("doc"), "heading", "content", "section_tag", "mentions_other_years")
    rows = hits.join(texts, "doc").withColumn("_labels", F.array().cast("array<string>"))
    scored = rows.withColumn("score", search.prior_boost("final_score", "section_tag", "mentions_other_years", "_labels"))
    return evidence.pack_evidence(scored.select("qid", F.col("doc").alias("id"), "heading", "content", "score"), "qid", budget, k)


def guarded_citations(citations: DataFrame, packed: DataFrame) -> DataFrame:
    """Citations (id, quote) of packed evidence only."""
    return valid_citations(citations, packed.select("id"), "id", "quote")


def normalized_names(df: DataFrame, text: str, label: str) -> DataFrame:
    return df.withColumn("normalized", normalize_entity(F.col(text), F.col(label)))
