"""Scores of papers as column expressions, none of which needs a shuffle or a join.

The unrolled form makes one CASE for each term and field, which fuses with the scan into one code-generated stage. Past
a few hundred terms score() takes the indexed form: a term is filed under a run of five of its characters (three, for short terms), and a text tries
only the terms filed under runs that it has. The array form (functions over a literal array) tries every term, whatever their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce
from itertools import accumulate
from operator import add

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Scoring, SearchTerms
from .text import normalize_category, to_number, to_text

OUT_OF_SCOPE = ("out_of_scope", "Out of scope")
#: Above so many terms in all topics together (or for all topics), score() takes the indexed form.
UNROLLED_TERMS = 300
#: A term is filed under a run of so many characters of its own, the first number that it has room for.
WIDTHS = (5, 3)
#: Slots of the index for each run that terms are filed under.
SLOTS = 4
#: At each place of a text the longest such run, or what there is of it at the end.
RUNS = f"(?s)(?=(.{{{WIDTHS[1]},{WIDTHS[0]}}}))"


def term_score(text: Column, terms) -> Column:
    """The sum of the weights of the terms that the text contains, each once. text: in lower case."""
    return reduce(add, (F.when(text.contains(t.lower()), F.lit(w)).otherwise(F.lit(0)) for t, w in terms), F.lit(0)).cast("long")


def _fields(cfg: Scoring) -> dict[str, float]:
    return {"title": cfg.title_weight, "abstract": cfg.abstract_weight, "query": cfg.query_weight}


def topic_score(terms, cfg: Scoring) -> Column:
    """One topic's score: the term scores of title, abstract and query, weighted."""
    return reduce(add, (F.lit(float(w)) * term_score(F.lower(to_text(c)), terms) for c, w in _fields(cfg).items()))


def topic_score_array(terms: SearchTerms, cfg: Scoring) -> Column:
    """The scores of all topics, in their order, as an array: the dictionary is one literal, the texts are made once a row."""
    if not terms.topics:
        return F.array().cast("array<double>")
    none = F.array().cast("array<struct<term:string,weight:int>>")
    topics = F.array(*(F.array(*(F.struct(F.lit(term.lower()).alias("term"), F.lit(w).cast("int").alias("weight")) for term, w in t.terms)) if t.terms else none for t in terms.topics))
    fields = F.struct(*(F.lower(to_text(c)).alias(c) for c in _fields(cfg)))

    def found(text: Column, listed: Column) -> Column:
        return F.aggregate(F.filter(listed, lambda x: F.contains(text, x["term"])), F.lit(0).cast("long"), lambda total, x: total + x["weight"])

    def scored(texts: Column) -> Column:
        return F.transform(topics, lambda listed: reduce(add, (F.lit(float(w)) * found(texts[c], listed) for c, w in _fields(cfg).items())))

    return F.transform(F.array(fields), scored)[0]


def _filed(listed: list[tuple[int, str, int]]) -> tuple[dict[str, list], list]:
    """(topic index, term in lower case, weight): the terms by the run of theirs that fewest terms have, and those too short to have one."""
    runs = [next((r for w in WIDTHS if (r := {t[i : i + w] for i in range(len(t) - w + 1)})), set()) for _, t, _ in listed]
    common = Counter(r for rs in runs for r in rs)
    filed: dict[str, list] = {}
    short = []
    for entry, rs in zip(listed, runs):
        if rs:
            filed.setdefault(min(rs, key=lambda r: (common[r], r)), []).append(entry)
        else:
            short.append(entry)
    return filed, short


def _xxhash64(text: str) -> int:
    """Spark's function of that name."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def with_index(listed: list[tuple[int, str, int]], use: Callable) -> Column:
    """use(hits), where hits(text) is the array<struct<topic, weight>> of the terms that the text, in lower case, contains, each once.

    The index is one literal of a few flat arrays, however many texts use(hits) looks at: the terms by slot (their run's hash modulo the number of slots), with their
    run's hash, and where each slot begins. The runs of a text are found in one pass and looked up once each; a term that is filed under one is tried by contains, so
    equal hashes cost time, not right results. The work grows with the text's length and the terms that it nearly has; every task reads the literal once."""
    if not listed:
        return use(lambda text: F.array().cast("array<struct<topic:int,weight:int>>"))
    filed, short = _filed(listed)
    n = max(1, SLOTS * len(filed))
    slots: list[list] = [[] for _ in range(n)]
    for run, terms in filed.items():
        h = _xxhash64(run)
        slots[h % n] += [(h, entry) for entry in terms]
    flat = [x for slot in slots for x in slot] + [(0, entry) for entry in short]
    words = [t for _, (_, t, _) in flat]
    mark = next(c for c in map(chr, range(0xE000, 0xF8FF)) if not any(c in t for t in words))

    def numbers(values, kind: str = "int") -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")

    index = F.struct(
        numbers(accumulate(map(len, slots), initial=0)).alias("start"),
        numbers((h for h, _ in flat), "bigint").alias("hash"),
        numbers(i for _, (i, _, _) in flat).alias("topic"),
        numbers(w for _, (_, _, w) in flat).alias("weight"),
        F.split(F.lit(mark.join(words)), mark).alias("term"),
    )
    filed_short = any(len(r) < WIDTHS[0] for r in filed)

    def hits(text: Column, ix: Column) -> Column:
        start, end = (lambda h, k=k: F.get(ix["start"], F.pmod(h, F.lit(n)).cast("int") + k) for k in (0, 1))
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(RUNS), 1))
        if filed_short:
            found = F.flatten(F.transform(found, lambda r: F.array(r, F.substring(r, 1, WIDTHS[1]))))
        held = F.filter(F.transform(found, lambda r: F.xxhash64(r)), lambda h: start(h) < end(h))
        tried = F.flatten(F.transform(F.array_distinct(held), lambda h: F.filter(F.sequence(start(h), end(h) - 1), lambda i: F.get(ix["hash"], i) == h)))
        if short:
            tried = F.concat(F.sequence(F.lit(len(flat) - len(short)), F.lit(len(flat) - 1)), tried)
        return F.transform(F.filter(tried, lambda i: F.contains(text, F.get(ix["term"], i))), lambda i: F.struct(F.get(ix["topic"], i).alias("topic"), F.get(ix["weight"], i).alias("weight")))

    return F.transform(F.array(index), lambda ix: use(lambda text: hits(text, ix)))[0]


def indexed_hits(text: Column, listed: list[tuple[int, str, int]]) -> Column:
    """array<struct<topic, weight>> of the terms that the text contains. text is an expression that is looked at several times."""
    return with_index(listed, lambda hits: hits(text))


def topic_scores_indexed(terms: SearchTerms, cfg: Scoring) -> Column:
    """What topic_score_array gives, by the index."""
    listed = [(i, t.lower(), w) for i, topic in enumerate(terms.topics) for t, w in topic.terms]
    topics = F.array(*(F.lit(i) for i in range(len(terms.topics)))).cast("array<int>")

    def total(hits: Column, topic: Column) -> Column:
        return F.aggregate(hits, F.lit(0).cast("long"), lambda a, x: a + F.when(x["topic"] == topic, x["weight"]).otherwise(F.lit(0)))

    def scored(texts: Column) -> Column:
        return F.transform(topics, lambda i: reduce(add, (F.lit(float(w)) * total(texts[c], i) for c, w in _fields(cfg).items())))

    # arrays of one, so that a text is searched once and not once a topic
    texts = F.array(F.struct(*(F.lower(to_text(c)).alias(c) for c in _fields(cfg))))
    fields = with_index(listed, lambda hits: F.transform(texts, lambda x: F.struct(*(hits(x[c]).alias(c) for c in _fields(cfg)))))
    return F.transform(fields, scored)[0]


def topic_scores_relational(papers: DataFrame, terms: SearchTerms, cfg: Scoring, key: str = "seq") -> DataFrame:
    """key, topic_idx, topic, score for every paper and topic."""
    names = F.array(*(F.lit(t.key) for t in terms.topics)).cast("array<string>")
    long = papers.select(key, F.posexplode(topic_score_array(terms, cfg)).alias("topic_idx", "score"))
    return long.select(key, "topic_idx", F.get(names, F.col("topic_idx")).alias("topic"), "score")


def best_topic(scores: list[tuple[str, str, Column]], values: Column | None = None, most: Column | None = None) -> Column:
    """struct(key, label, score) of the largest score, the first of equals; out of scope if it isn't above 0. values, most: the scores as an array and the largest, where they are known."""
    none = F.struct(F.lit(OUT_OF_SCOPE[0]).alias("key"), F.lit(OUT_OF_SCOPE[1]).alias("label"), F.lit(0.0).alias("score"))
    if not scores:
        return none
    # by place in an array: a CASE over all topics would repeat every score for every topic
    values = F.array(*(s for _, _, s in scores)) if values is None else values
    most = F.array_max(values) if most is None else most
    at = F.array_position(values, most).cast("int")
    names = [F.element_at(F.array(*(F.lit(x[i]) for x in scores)), at) for i in (0, 1)]
    return F.when(most > 0, F.struct(names[0].alias("key"), names[1].alias("label"), most.alias("score"))).otherwise(none)


def _all_text() -> Column:
    return F.lower(F.concat_ws(" ", to_text("title"), to_text("abstract"), to_text("query")))


def generic_score(terms, cfg: Scoring) -> Column:
    """Term score of title, abstract and query as one text, where a term may run from one into the next."""
    text = _all_text()
    if len(terms) <= UNROLLED_TERMS:
        return term_score(text, terms)
    hits = F.transform(F.array(text), lambda x: indexed_hits(x, [(0, t.lower(), w) for t, w in terms]))[0]
    return F.aggregate(hits, F.lit(0).cast("long"), lambda a, x: a + x["weight"])


def bonuses(cfg: Scoring) -> Column:
    venue, kind = normalize_case("venue_type"), normalize_case("openalex_type")
    given = ((venue, "journal", cfg.journal_bonus), (venue, "conference", cfg.conference_bonus), (kind, "preprint", cfg.preprint_bonus), (kind, "dataset", cfg.dataset_bonus))
    return reduce(add, (F.when(c == value, F.lit(float(b))).otherwise(F.lit(0.0)) for c, value, b in given))


def normalize_case(c: str) -> Column:
    return F.lower(to_text(c))


def penalties(cfg: Scoring) -> Column:
    taken = (
        (F.coalesce(F.col("is_repository"), F.lit(False)), cfg.repository_penalty),
        (normalize_case("openalex_type") == "report", cfg.report_penalty),
        (~F.coalesce(F.col("has_abstract"), F.lit(False)), cfg.missing_abstract_penalty),
    )
    return reduce(add, (F.when(c, F.lit(float(p))).otherwise(F.lit(0.0)) for c, p in taken))


def citation_bonus(cfg: Scoring, citations: str | Column = "citation_count") -> Column:
    """Grows with the logarithm of the citations, up to a bound; 0 where there is no sensible count."""
    n = to_number(citations)
    return F.when(n > -1, F.least(F.lit(float(cfg.max_citation_bonus)), F.lit(float(cfg.citation_weight)) * F.log1p(n))).otherwise(F.lit(0.0))


def score(papers: DataFrame, terms: SearchTerms, cfg: Scoring) -> DataFrame:
    """papers with topic, topic_label, topic_score, generic_priority_score, triage_score (and relevance_score, the same).

    All of them come from one expression, in arrays of one: a filter on a score, which Spark moves below the projection, repeats it once, and neither
    texts in lower case nor scores are made again for each term that looks at them."""
    listed = [(i, t.lower(), w) for i, topic in enumerate(terms.topics) for t, w in topic.terms]
    many = len(listed) > UNROLLED_TERMS
    fields = _fields(cfg)

    def topics(texts: Column) -> Column:
        if not terms.topics:
            return F.array().cast("array<double>")
        return F.array(*(reduce(add, (F.lit(float(w)) * term_score(texts[c], t.terms) for c, w in fields.items())) for t in terms.topics))

    def named(x: Column) -> Column:
        outside = x["most"] <= 0
        best = best_topic([(t.key, t.label, F.get(x["scores"], F.lit(i))) for i, t in enumerate(terms.topics)], x["scores"], x["most"])
        total = x["most"] + float(cfg.generic_priority_weight) * x["generic"] + bonuses(cfg) - penalties(cfg) + citation_bonus(cfg)
        return F.struct(
            best.alias("best"),
            F.when(outside, F.lit(0.0)).otherwise(F.round(x["generic"], 3)).alias("generic"),
            F.when(outside, F.lit(0.0)).otherwise(F.round(F.greatest(total, F.lit(0.0)), 3)).alias("triage"),
        )

    def scored(texts: Column) -> Column:
        scores = topic_scores_indexed(terms, cfg) if many else topics(texts)
        generic = (term_score(texts["all"], terms.generic) if len(terms.generic) <= UNROLLED_TERMS else generic_score(terms.generic, cfg)).cast("double")
        return F.transform(F.array(F.struct(scores.alias("scores"), generic.alias("generic"))), lambda x: x.withField("most", F.coalesce(F.array_max(x["scores"]), F.lit(0.0))))[0]

    texts = F.struct(*(F.lower(to_text(c)).alias(c) for c in fields), _all_text().alias("all"))
    made = F.transform(F.transform(F.array(texts), scored), named)[0]
    s = papers.withColumn("_score", made)
    out = s.withColumns(
        {
            "topic": F.col("_score.best.key"),
            "topic_label": F.col("_score.best.label"),
            "topic_score": F.round("_score.best.score", 3),
            "generic_priority_score": F.col("_score.generic"),
            "triage_score": F.col("_score.triage"),
            "relevance_score": F.col("_score.triage"),
        }
    )
    return out.drop("_score")


def priority_rank(c: str | Column) -> Column:
    p = normalize_category(c)
    return F.when(p == "read", 0).when(p == "skim", 1).otherwise(2)
