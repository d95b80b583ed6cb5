"""The Markdown report of recommended papers, as an ordered table of texts and then a file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import strip, to_text
from ..operators.aggregates import any_text, priority_counts, ranked_counts
from ..operators.filters import has_deep_analysis, has_priority, require_columns
from ..operators.order import report_keys, with_ordinal
from ..sinks import write_markdown
from ..sources.tables import read_table

#: What the report says before each value, in order (fixed values).
META = (("Authors", "authors"), ("Year", "year"), ("Venue", "venue"), ("Published", "published_date"))
STANZA = (("Recommendation", "llm_priority", "`"), ("Relevance", "llm_relevance", "`"), ("Topic", "topic_label", ""), ("Triage score", "triage_score", ""), ("Fast LLM confidence", "llm_confidence", ""))
FAST = (
    ("Fast summary", "llm_summary"),
    ("Main contribution", "llm_main_contribution"),
    ("Method", "llm_method"),
    ("Datasets / benchmarks", "llm_datasets_or_benchmarks"),
    ("Key terms", "llm_key_terms"),
    ("Fast relevance to review", "llm_relevance_to_review"),
    ("Why it was recommended", "llm_reason"),
)
DEEP = (
    ("Deep-analysis confidence", "deep_confidence"),
    ("Deep summary", "deep_summary"),
    ("Problem / gap", "deep_problem"),
    ("Deep method analysis", "deep_method"),
    ("Deep datasets / benchmarks", "deep_datasets"),
    ("Reported results", "deep_results"),
    ("Limitations / caveats", "deep_limitations"),
    ("Deep relevance to review", "deep_relevance_to_review"),
    ("Reading notes", "deep_reading_notes"),
)
PRIORITIES = ("read", "skim")


def paper_block(columns: list[str], ordinal: str = "ordinal") -> Column:
    """One paper's part of the report. Parts without a value are left out."""

    def cell(name: str) -> Column:
        return strip(to_text(name)) if name in columns else F.lit("")

    def line(title: str, name: str) -> Column:
        return F.when(cell(name) != "", F.concat(F.lit(f"**{title}:** "), cell(name)))

    meta = F.concat_ws("\n", *(line(*x) for x in META))
    stanza = F.concat_ws("  \n", *(F.concat(F.lit(f"**{t}:** {q}"), cell(c), F.lit(q)) for t, c, q in STANZA))
    deep = F.when(has_deep_analysis(columns), F.concat_ws("\n\n", F.lit("#### Deep analysis"), *(line(*x) for x in DEEP)))
    place = F.coalesce(line("DOI", "doi"), line("URL", "url"))
    head = F.concat(F.lit("### "), F.col(ordinal).cast("string"), F.lit(". "), cell("title"))
    return F.concat_ws("\n\n", head, F.nullif(meta, F.lit("")), stanza, *(line(*x) for x in FAST), deep, place)


def recommended(table: DataFrame, priorities: tuple[str, ...] = PRIORITIES) -> DataFrame:
    """The rows of the wanted priorities; ValueError where the table has none at all."""
    require_columns(table, "llm_priority")
    return table.where(has_priority(priorities))


def report_lines(table: DataFrame, priorities: tuple[str, ...] = PRIORITIES) -> DataFrame:
    """section, line_no (1, 2, ... over the whole report), text. No rows where nothing is recommended. Every text is one or more lines; joined by line
    ends they are the report."""
    wanted = recommended(table, priorities)
    papers = with_ordinal(wanted, report_keys(wanted))
    n, say = wanted.columns, F.concat
    sections = [(title, column) for title, column in (("## Counts by topic", "topic_label"), ("## Counts by LLM relevance", "llm_relevance")) if column in n]
    distinct = [F.count_distinct(F.coalesce(F.col(c), F.lit("Unknown"))).alias(f"lines_{c}") for _, c in sections]
    counts = priority_counts(wanted, any_text(wanted, "deep_summary").alias("has_deep"), *distinct).where("n_total > 0")
    head = [
        F.lit("# Recommended Papers Summary"),
        F.lit(""),
        say(F.lit("Total recommended papers: **"), F.col("n_total"), F.lit("**")),
        say(F.lit("- Read: **"), F.col("n_read"), F.lit("**")),
        say(F.lit("- Skim: **"), F.col("n_skim"), F.lit("**")),
        say(F.lit("- Contains deep-analysis notes: **"), F.when(F.col("has_deep"), "yes").otherwise("no"), F.lit("**")),
        F.lit(""),
    ]

    # lines before each section, and the lines that every report has: (section, lines before, texts)
    before = [F.lit(len(head)).cast("long")]
    fixed = [(0, F.lit(0).cast("long"), head)]
    for i, (title, column) in enumerate(sections, 1):
        labels = F.col(f"lines_{column}")
        fixed += [(i, before[-1], [F.lit(title), F.lit("")]), (i, before[-1] + 2 + labels, [F.lit("")])]
        before.append(before[-1] + 3 + labels)
    fixed.append((3, before[-1], [F.lit("## Papers"), F.lit("")]))
    lines = [F.struct(F.lit(i).alias("section"), (after + k).alias("line_no"), text.alias("text")) for i, after, texts in fixed for k, text in enumerate(texts, 1)]
    parts = [counts.select(F.inline(F.array(*lines)))]

    def start(i: int) -> Column:
        """The lines before section i's own ones: one subquery for all sections."""
        return F.get(counts.select(F.array(*before)).scalar(), F.lit(i)) + 2

    for i, (_, column) in enumerate(sections, 1):
        shown = say(F.lit("- "), F.col("label"), F.lit(": **"), F.col("n"), F.lit("**"))
        ranked = ranked_counts(wanted, column, report_keys(wanted)).select(shown.alias("text"), "place")
        parts.append(ranked.select(F.lit(i).alias("section"), (start(i - 1) + F.col("place")).alias("line_no"), "text"))
    both = F.array(paper_block(n), F.lit("\n---\n"))
    blocks = papers.select("ordinal", F.posexplode(both).alias("place", "text"))
    parts.append(blocks.select(F.lit(3).alias("section"), (start(len(sections)) + 2 * F.col("ordinal") + F.col("place") - 1).alias("line_no"), "text"))
    return reduce(DataFrame.unionByName, parts).withColumn("line_no", F.col("line_no").cast("int"))


def run(spark: SparkSession, cfg: Config, priorities: tuple[str, ...] = PRIORITIES) -> bool:
    """Write the report of the configured table; False, and no file, where nothing is recommended."""
    table = read_table(spark, cfg.sota_table_path)
    if not recommended(table, priorities).limit(1).count():
        return False
    write_markdown(report_lines(table, priorities), cfg.recommended_summary_path)
    return True
