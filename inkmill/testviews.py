"""Paper-shaped views of the test tables, in SQL that Spark and DuckDB both run, and the dictionaries that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .config import Config, SearchTerms

TERMS = SearchTerms.of(
    {
        "topics": {
            "en": {"label": "English", "queries": ["the", "tion here"], "topic_terms": {"the": 5, "tion": 4, "here": 3}},
            "fr": {"label": "French", "queries": ["eau"], "topic_terms": {"eau": 5, "Aux": 4}},
            "de": {"queries": ["sch ung", "der"], "topic_terms": {"sch": 5, "ung": 4}},
            "es": {"label": "Spanish", "topic_terms": {"ción": 5, "dad": 4, "que": -1}},
        },
        "generic_priority_terms": {"ing": 3, "ment": 2, "keit": 2, "src1": 1},
    }
)
CONFIG = Config.of({"output_dir": "out", "sota_table_path": "out/table", "min_triage_score": 30, "drop_existing_below_min_score": True, "include_repositories": False})

#: One paper a document; some lack an abstract, a DOI, a date or everything that could identify them.
PAPERS = """
select doc_id as seq, 'doc:' || cast(doc_id as varchar(20)) as paper_id, 'docs' as source,
  case when doc_id % 23 = 0 then '' else split_part(text, chr(10), 1) end as title,
  case when doc_id % 17 = 0 then null else text end as abstract,
  case when doc_id % 17 = 0 then false else true end as has_abstract,
  source as query, lang as search_topic,
  case doc_id % 4 when 0 then 'Journal' when 1 then 'conference' when 2 then 'repository' else '' end as venue_type,
  'Venue ' || cast(doc_id % 7 as varchar(20)) as venue,
  case when doc_id % 4 = 2 then true else false end as is_repository,
  case doc_id % 5 when 0 then 'preprint' when 1 then 'Dataset' when 2 then 'report' else 'article' end as openalex_type,
  case when doc_id % 11 = 0 then null else n_chars end as citation_count,
  case when doc_id % 3 = 0 then ' 10.1/' || upper(lang) || cast(n_chars as varchar(20)) || ' ' else '' end as doi,
  case when doc_id % 3 = 1 and doc_id % 2 = 0 then cast(n_chars as varchar(20)) || '.v1' else '' end as arxiv_id,
  case when doc_id % 3 = 2 and doc_id % 5 = 1 then 'https://x.org/' || source else '' end as url,
  case when doc_id % 13 = 0 then null else '202' || cast(doc_id % 6 as varchar(20)) || '-0' || cast(1 + doc_id % 9 as varchar(20)) || '-11' end as published_date,
  2000 + cast(doc_id % 26 as int) as year, 'Author ' || source as authors,
  case doc_id % 6 when 0 then 'read' when 1 then ' Skim ' when 2 then 'ignore' when 3 then 'error' when 4 then '' else null end as llm_priority,
  case doc_id % 5 when 0 then 'direct' when 1 then null else 'partial' end as llm_relevance,
  case when doc_id % 7 = 0 then null else upper(lang) end as topic_label,
  case doc_id % 9 when 0 then 'n/a' when 1 then null when 2 then ' 12.5 ' when 3 then '7d' when 4 then '1e2' else cast(n_chars % 97 as varchar(20)) end as score_text,
  case when doc_id % 10 = 0 then 'Deep ' || source else '' end as deep_summary,
  case when doc_id % 15 = 0 then ' note ' else null end as deep_reading_notes
from {documents}
"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAPERS, documents=spark.read.parquet(f"{sf_dir}/documents.parquet"))
