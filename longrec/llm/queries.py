"""Registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.llm import decontamination, exact_dedup, line_dedup, merkle, ngram_join, packing, passages, planted, quality, secret_scan, token_counts, toxicity, url_filter, warc, whitening
from longrec.llm.common import read_table
from longrec.llm.samples import crc32_of_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its oracle."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


NGRAM_SQL = r"""
with recursive words as (
    select doc_id, [x for x in string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w
    from documents
), sets as (
    select doc_id, list_distinct(case when len(w) >= 5
        then [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from words
), one as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (
    select a.doc_id as x, b.doc_id as y
    from one a join one b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
    select doc_id as x, doc_id as y from documents
    union select r.x, p.y from reach r join pairs p on r.y = p.x
)
select d.doc_id, coalesce(len(s.s), 0) as n_shingles, min(r.y) as component_id
from documents d join sets s on d.doc_id = s.doc_id join reach r on d.doc_id = r.x
group by d.doc_id, s.s
"""


LINES_SQL = r"""
with split as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as pos
    from documents
), lines as (
    select doc_id, pos, trim(line, ' ') as line, len(regexp_extract_all(line, '\S+')) as words
    from split where regexp_matches(line, '\S')
), counted as (
    select *, sum(words) over (partition by doc_id order by pos) as upto from lines
), runs as (
    select doc_id, 'from' as side, list(line) over w as content, list(pos) over w as places, sum(words) over w as size
    from counted window w as (partition by doc_id order by upto - words range between current row and 49 following)
    union all
    select doc_id, 'to', list(line) over w, list(pos) over w, sum(words) over w
    from counted window w as (partition by doc_id order by upto range between 49 preceding and current row)
), ranked as (
    select doc_id, places, row_number() over same as nth, first_value(doc_id) over same as first_id, first_value(places) over same as first_places
    from runs where size >= 50 window same as (partition by side, content order by doc_id, places[1])
), deleted as (
    select distinct doc_id, unnest(places) as pos from ranked where nth > 1 and (doc_id <> first_id or places[1] > first_places[-1])
)
select s.doc_id, count(d.pos)::integer as n_deleted,
       coalesce(string_agg(s.line, chr(10) order by s.pos) filter (where d.pos is null), '') as text
from split s left join deleted d on s.doc_id = d.doc_id and s.pos = d.pos
group by s.doc_id
"""


@query("op1_line_dedup", LINES_SQL)
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_passage_dedup")
def passage_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.dedup_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc32_of_id() % 3 == 1, F.lit(False))
    model = toxicity.fit(docs, labels, learn=~held_out)
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


WARC_SQL = """
with payloads as (
    select page_id, coalesce(html, '') as payload, min(page_id) over (partition by coalesce(html, '')) as first from pages
), digests as (
    select *, sha1(payload) as hex from payloads
)
select page_id, strlen(payload) as payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(hex, 5 * i + 1, 5))::integer >> (5 * (3 - j))) & 31)::integer + 1, 1)), '')), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from digests
"""


@query("op3_warc", WARC_SQL)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query("op4_decontamination")
def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op5_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_token_counts")
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), path, limit=512)


@query("op7_ngram_join", NGRAM_SQL)
def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(read_table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def secret_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no labelled findings: the forest learns from half of those planted into pieces of the documents."""
    docs = read_table(spark, sf_dir, "documents")
    corpus = secret_scan.corpus_statistics(docs)
    taught = planted.labelled_findings(docs, corpus)
    return secret_scan.score(secret_scan.findings(docs, corpus), secret_scan.fit(taught.where("id div 2 % 2 = 0")))


@query("op9_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))
    model = quality.fit(docs, labels, learn=~held_out)
    scored = quality.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query(
    "op10_exact_dedup",
    """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))
    """,
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classify(read_table(spark, sf_dir, "documents"))


URL_SQL = r"""
with parts as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path
    from pages
), rules (rule_host, rule_path, verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting as (
    select page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) as best
    from parts, rules
    where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by page_id
)
select p.page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
from parts p left join fitting f on p.page_id = f.page_id
"""


@query("op11_url_filter", URL_SQL)
def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op12_embedding_whitening")
def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return whitening.whitened_rows(rows, whitening.fit(rows, components=4))


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """Tables of one tree over (part, pos, node, cnt): nodes and their siblings of each level."""
    tables = [f"{name}0 as ({leaves})"]
    for k in range(levels):
        tables.append(
            f"{name}{k + 1} as (select part, pos // 16 as pos, (any_value(cnt) + 15) // 16 as cnt,"
            f" case when any_value(cnt) > 1 then sha256(string_agg(node, '' order by pos)) else any_value(node) end as node"
            f" from {name}{k} group by part, pos // 16)"
        )
        tables.append(
            f"{name}s{k} as (select *, coalesce(string_agg(node, '') over (run rows between unbounded preceding and 1 preceding), '') as l,"
            f" coalesce(string_agg(node, '') over (run rows between 1 following and unbounded following), '') as r"
            f" from {name}{k} window run as (partition by part, pos // 16 order by pos))"
        )
    return ", ".join(tables)


def _climb_sql(name: str, rows: str, start: str, levels: int) -> str:
    """``rows`` (part, pos) with the siblings on the way up and the node that ``start`` leads to."""
    tables = [f"{name}_0 as (select *, '' as proof, {start} as folded from {rows})"]
    for k in range(levels):
        tables.append(
            f"{name}_{k + 1} as (select c.* exclude (proof, folded), proof || s.l || s.r as proof,"
            f" case when s.cnt > 1 then sha256(s.l || folded || s.r) else folded end as folded"
            f" from {name}_{k} c join {name}s{k} s on c.part = s.part and c.pos // {16**k} = s.pos)"
        )
    return ", ".join(tables)


_FIELDS = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_LEVELS = 6
#: Trees of up to 16 ** 6 rows a source and as many sources.
MERKLE_SQL = f"""
with hashed as (
    select doc_id, coalesce('=' || source, '') as part, sha256({_FIELDS} || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           sha256({_FIELDS} || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) as lowered,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                   lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) as crc
    from documents
), placed as (
    select *, row_number() over (partition by part order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by part) as cnt,
           case when crc % 5 = 0 then lowered else leaf end as presented
    from hashed
), {_tree_sql("d", "select part, pos, leaf as node, cnt from placed", _LEVELS)},
tops as (
    select '' as part, part as own, row_number() over (order by part) - 1 as pos, node, count(*) over () as cnt from d{_LEVELS}
), {_tree_sql("t", "select part, pos, node, cnt from tops", _LEVELS)},
{_climb_sql("d", "placed", "presented", _LEVELS)},
proven as (
    select c.doc_id, c.leaf, tops.node as subroot, tops.pos, '' as part, c.proof as below, c.folded as reached
    from d_{_LEVELS} c join tops on c.part = tops.own
), {_climb_sql("t", "proven", "reached", _LEVELS)}
select doc_id, leaf, subroot, t{_LEVELS}.node as root, sha256(below || proof) as proof_sha256, folded as folded_root,
       folded = t{_LEVELS}.node as verified
from t_{_LEVELS}, t{_LEVELS}
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents, and which rows of a tampered copy it still verifies."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read_table(spark, sf_dir, "documents").select(*columns)
    tampered = F.coalesce(crc32_of_id() % 5 == 0, F.lit(False)) & F.col("text").rlike("[A-Z]")
    docs = docs.withColumn("lowered", F.when(tampered, F.translate("text", *url_filter.LOWER)))
    presented = F.when(F.col("lowered").isNotNull(), merkle.record_hash([*columns[:-1], "lowered"]))
    docs = docs.withColumn("presented", presented)
    proven = merkle.manifest(docs, "source", ["doc_id"], merkle.record_hash(columns), carry=["doc_id", "presented"])
    folded = merkle.fold(F.coalesce("presented", "leaf"), F.col("proof"))
    proven = proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))
