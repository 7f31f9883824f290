"""Queries of the text operators over the given tables, and SQL that gives the same rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidewise.session import scratch_path

from . import (
    bpe, chat, decontaminate, exact_dedup, filter_audit, line_dedup, near_dedup, pattern_packing, periodic_runs, secret_ledger, shards, token_files, toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op2_exact_dedup",
    f"""
    with rows as (select doc_id, sha256({_FOLD.format("coalesce(text, '')")}) as text_sha256 from documents)
    select doc_id, keep_id, group_size, coalesce(doc_id = keep_id, doc_id is null and keep_id is null) as kept, text_sha256
    from rows join (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from rows group by text_sha256) using (text_sha256)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query(
    "op3_chat_rotation",
    """
    with said as (
        select conv_id, turn, translate(coalesce(role, 'unknown'), chr(10), ' ') as speaker,
               replace(coalesce(text, ''), '<|', '< |') as body
        from conversations
    ), people as (
        select distinct conv_id, speaker as perspective from said where speaker <> 'system'
    ), rows as (
        select s.conv_id, perspective, turn, speaker, speaker = perspective as trained, body,
               '<|im_start|>' || case when speaker = 'system' then 'system' when speaker = perspective then 'assistant'
                                      else 'user name=' || replace(speaker, '<|', '< |') end || chr(10) as opening
        from said s join people p on s.conv_id is not distinct from p.conv_id
    ), rendered as (
        select *, opening || body || '<|im_end|>' || chr(10) as rendered from rows
    ), placed as (
        select *, row_number() over w as seq, coalesce(sum(length(rendered)) over (w rows between unbounded preceding and 1 preceding), 0)::bigint as start
        from rendered window w as (partition by conv_id, perspective order by turn nulls first, speaker, body)
    )
    select conv_id, perspective, seq, turn, speaker, trained, rendered, start,
           case when trained then start + length(opening) end as mask_start,
           case when trained then start + length(opening) + length(body) + 10 end as mask_end
    from placed
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotations(table(spark, sf_dir, "conversations"))


@query("op4_interleaved_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.report(table(spark, sf_dir, "documents"))


@query("op5_secret_ledger")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over the ledger of an earlier load, which held a part of them and knew the base rules only."""
    docs = table(spark, sf_dir, "documents")
    earlier = docs.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    ledger, _ = secret_ledger.scan(earlier, rules=secret_ledger.RULES)
    _, findings = secret_ledger.scan(docs, ledger)
    return secret_ledger.report(findings)


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(docs, scratch_path(spark, "llm-tokens"), public_tokenizers.path("word_bpe_49k.json")))


@query(
    "op7_line_dedup",
    f"""
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as line_no
        from documents
    ), keyed as (
        select *, {_FOLD.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines
    ), shared as (
        select key, min(doc_id) as keeper from keyed where length(key) >= 10 group by key having count(distinct doc_id) >= 2
    ), marked as (
        select doc_id, line, line_no, coalesce(doc_id <> keeper, false) as dropped from keyed left join shared using (key)
    )
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by line_no) filter (not dropped), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def echoed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the crc32 of its id, repeats a stretch of its words to its end."""
    if doc_id is None or not words:
        return words
    hashed = zlib.crc32(str(doc_id).encode())
    if hashed % 10:
        return words
    seed, n = hashed // 10, len(words)
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    return [*words[:start], *(words[start + i % period] for i in range(n - start))]


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"), echoed)


@query("op12_pattern_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pattern_packing.pack(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


@query(
    "op13_filter_audit",
    """
    with recursive words as (
        select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\v]+'), lambda w: w <> '') as ws,
               min(doc_id) over (partition by coalesce(text, '')) as first_id
        from documents
    ), flagged as (
        select doc_id, part, len(ws) < 200 as a, 100 * len(list_distinct(ws)) < 50 * len(ws) as b,
               100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text) as c,
               length(translate(text, '#$%&*|', '')) < length(text) as d, coalesce(doc_id > first_id, false) as e
        from words
    ), said as (
        select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id
    ), masked as (
        select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask,
               count(*) as n, count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as toxic
        from flagged left join said using (doc_id) group by 1, 2
    ), filters(name, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders(filter_order, bits) as (
        select '', 0
        union all
        select filter_order || name, bits + bit from orders, filters where bits & bit = 0
    ), steps as (
        select o.filter_order, step, bit as own,
               list_sum([case x when 'A' then 1 when 'B' then 2 when 'C' then 4 when 'D' then 8 else 16 end for x in string_split(o.filter_order[1:step - 1], '') if x <> '']) as prior
        from orders o, (select unnest(range(1, 6))::int as step), filters where bits = 31 and name = o.filter_order[step]
    ), counted as (
        select part, filter_order, step, own,
               sum(n) filter (mask & (own | coalesce(prior, 0)::int) = 0) as kept,
               sum(n) filter (mask & own <> 0 and mask & coalesce(prior, 0)::int = 0) as removed,
               sum(n) filter (mask & own <> 0 and mask & coalesce(prior, 0)::int <> 0) as redundant,
               sum(n) filter (mask = own) as unique_fails,
               sum(good) filter (mask & own <> 0 and mask & coalesce(prior, 0)::int = 0) as good_lost,
               sum(toxic) filter (mask & own <> 0 and mask & coalesce(prior, 0)::int = 0) as toxic_lost
        from masked, steps group by all
    )
    select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
           coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
           coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
           (sum(coalesce(removed, 0)) over (partition by part, own))::bigint as shapley
    from counted
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
