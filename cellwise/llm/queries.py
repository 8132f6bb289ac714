"""One query per operator, over its whole table, and the SQL that gives the same rows.

Each takes (spark, folder of tables) and applies the operator with its production
parameters; digest columns are derived from the operator's output here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import scratch_path

from . import contamination, divergence, embedding, fixity, importance, language, packing, passages, secrets, simhash, substrings, tokenfiles, toxicity
from .spread import table

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


OP9_SQL = """
with r as (
    select page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
        || coalesce(cast(page_id as varchar), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || cast(strlen(coalesce(html, '')) as varchar)
        || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as rec
    from pages
)
select page_id, cast(strlen(rec) as bigint) as n_bytes, sha256(rec) as record_sha256,
    case when page_id % 251 = 7 then 'corrupt' when page_id % 509 = 11 then 'missing' else 'ok' end as status
from r
"""


OP12_SQL = r"""
with d as (
    select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
),
w as (select lang, source, r, unnest(terms) as term from d),
kept as (select lang, term from w group by lang, term having count(distinct r) >= 30),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from w join kept using (lang, term) group by all),
v as (select lang, count(*) as v from kept group by lang),
full_c as (
    select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n from g join kept k on g.lang = k.lang
    left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
p as (
    select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * v) as p
    from full_c join v using (lang)
),
q as (select lang, term, sum(n) as n from p group by lang, term),
ql as (select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang) + 5 * v) as q from q join v using (lang)),
pair as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join (select s.lang, s.source, t.source as item, sum(abs(s.p - t.p)) as value from p s join p t on s.lang = t.lang and s.term = t.term group by all) x
        on x.lang = a.lang and x.source = a.source and x.item = b.source
),
term as (select lang, source, 'term' as part, term as item, p - q as value from p join ql using (lang, term) where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from (select * from pair union all select * from term)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 50
"""


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector with its links and component; rows that share a vec_id are one vertex, an empty table gives no row."""
    return embedding.near_duplicates(table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored, null and empty texts too; repeated ids row by row, without labels all scores are one half."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its repeated windows of 20 words; null texts have no words, rows that share an id do not remove from one another."""
    found = passages.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language; null texts and texts without a letter are ``und``, repeated ids are predicted row by row."""
    return language.language(table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and component; null and empty texts have fingerprint zero and are linked like any other."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its repeated strings of 50 bytes; null texts are empty, rows that share an id do not remove from one another."""
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's spans; null and empty texts have none, repeated ids are scanned row by row."""
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return found.withColumn("spans", secrets.spans_text())


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document and its place; null and empty texts are one piece that holds the end id."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op9_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Audits a replica of the pages that has lost a byte here and a record there."""
    pages = table(spark, folder, "pages")
    whole = fixity.record(F.col("page_id"), F.col("url"), F.col("html"))
    records = pages.select("page_id", whole.alias("record"))
    damaged = F.when(F.col("page_id") % 251 == 7, F.expr("substring(record, 1, octet_length(record) - 1)")).when(F.col("page_id") % 509 == 11, F.lit(None))
    replica = records.withColumn("copy", damaged.otherwise(F.col("record")))
    found = fixity.audit(replica, "page_id", "record", "copy")
    return found.select(F.col("id").alias("page_id"), "n_bytes", F.col("sha256").alias("record_sha256"), "status")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every item; null and empty texts and items match nothing, an empty table on either side finds nothing."""
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Writes all documents as token files and reads their places and sums back from these."""
    written = scratch_path(spark, "token-files")
    tokenfiles.write(table(spark, folder, "documents"), written, public_tokenizers.path(TOKENIZER))
    return tokenfiles.read(spark, written)


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of sources of a language, and the terms that mark each source."""
    return divergence.divergence(table(spark, folder, "documents"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn by their likeness to the benchmark."""
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_ALL = [op1_embedding_dedup, op2_toxicity, op3_passages, op4_language, op5_packing, op6_simhash, op7_substrings, op8_secrets, op9_fixity, op10_decontamination]
_ALL += [op11_token_files, op12_divergence, op13_importance]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _ALL}


def oracle_sql() -> dict[str, str]:
    return {"op9_fixity": OP9_SQL, "op12_divergence": OP12_SQL}
