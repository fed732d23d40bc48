"""The staging and curated tables: their columns, what must not be null, and how a frame is brought to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HADITHS = "source_id string, source_corpus string, collection_name string, book_number int, chapter_number int, hadith_number int, matn_ar string, matn_en string, isnad_raw_ar string, isnad_raw_en string, full_text_ar string, full_text_en string, grade string, chapter_name_ar string, chapter_name_en string, sect string"
MENTIONS = "mention_id string, source_hadith_id string, source_corpus string, position_in_chain int, chain_index int, name_ar string, name_en string, name_ar_normalized string, transmission_method string"
BIOS = "bio_id string, source string, name_ar string, name_en string, name_ar_normalized string, name_en_normalized string, kunya string, nisba string, laqab string, birth_year_ah int, birth_year_ah_earliest int, birth_year_ah_latest int, birth_date_precision string, death_year_ah int, death_year_ah_earliest int, death_year_ah_latest int, death_date_precision string, birth_location string, death_location string, generation string, gender string, trustworthiness string, bio_text string, external_id string"
COLLECTIONS = "collection_id string, name_ar string, name_en string, compiler_name string, compilation_year_ah int, sect string, total_hadiths int, expected_count int, source_corpus string"
EDGES = "from_narrator_name string, to_narrator_name string, hadith_id string, source string, from_external_id string, to_external_id string, relation string"
ALIASES = "bio_id string, source string, canonical_name_ar_normalized string, alias string, alias_normalized string"
LINKS = "hadith_id_a string, hadith_id_b string, similarity_score float, variant_type string, cross_sect boolean"
TABLES = {"hadiths": HADITHS, "narrator_mentions": MENTIONS, "narrators_bio": BIOS, "collections": COLLECTIONS, "network_edges": EDGES, "narrator_aliases": ALIASES, "parallel_links": LINKS}
REQUIRED = {
    "hadiths": ("source_id", "source_corpus", "collection_name", "sect"), "narrator_mentions": ("mention_id", "source_hadith_id", "source_corpus", "position_in_chain"),
    "narrators_bio": ("bio_id", "source"), "narrator_aliases": ("bio_id", "source", "canonical_name_ar_normalized", "alias"), "collections": ("collection_id", "name_en", "sect", "source_corpus"),
    "network_edges": ("from_narrator_name", "to_narrator_name", "source"), "parallel_links": ("hadith_id_a", "hadith_id_b", "similarity_score", "variant_type", "cross_sect"),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and of their types; columns that are not there are null, others are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in StructType.fromDDL(TABLES[table])])
