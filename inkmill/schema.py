"""Schemas: the paper record, the payloads of the two search services, and what language models return."""

from __future__ import annotations

from pyspark.sql import types as T

WORK_DDL = """
id string, title string, ids map<string,string>,
authorships array<struct<author: struct<display_name: string>>>,
locations array<struct<source: struct<display_name: string, type: string>>>,
primary_location struct<source: struct<display_name: string, type: string>>,
abstract_inverted_index map<string, array<int>>,
publication_year int, publication_date string, updated_date string,
cited_by_count bigint, type string, type_crossref string
"""

FEED_DDL = """
entry array<struct<id: string, published: string, updated: string, title: string, summary: string,
author: array<struct<name: string>>, link: array<struct<_title: string, _href: string>>>>
"""

SCAN_DDL = """
paper_id string, source string, title string, authors string, year int, published_date string, updated_date string,
venue string, venue_type string, abstract string, has_abstract boolean, url string, doi string, arxiv_id string,
semantic_scholar_id string, openalex_id string, query string, citation_count bigint, is_repository boolean,
openalex_type string, openalex_crossref_type string
"""

SCORE_DDL = """
search_topic string, topic string, topic_label string, topic_score double, generic_priority_score double, triage_score double,
relevance_score double, manual_decision string, notes string
"""

TRIAGE_DDL = """
llm_priority string, llm_relevance string, llm_topic string, llm_reason string, llm_key_terms string,
llm_is_dataset_or_benchmark boolean, llm_mentions_code_or_release boolean, llm_confidence double
"""

DEEP_DDL = """
deep_summary string, deep_problem string, deep_method string, deep_datasets string, deep_results string, deep_limitations string,
deep_relevance_to_review string, deep_reading_notes string, deep_confidence double
"""


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def columns(ddl: str) -> T.StructType:
    """The schema of flat columns; needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in ddl.split(","))])


SCAN, TRIAGE, DEEP = columns(SCAN_DDL), columns(TRIAGE_DDL), columns(DEEP_DDL)
PAPER = T.StructType(SCAN.fields + columns(SCORE_DDL).fields + TRIAGE.fields + DEEP.fields)
