"""Registered queries of the training-data operators, and SQL with the same result where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlens.llm import byte_bpe, exact_dedup, licenses, merkle, mixing, near_dedup, piecewise_hash, quality, simhash, spelling
from cartlens.llm import token_counts, token_store, wrappers
from cartlens.llm.common import documents, scratch

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 2


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), WORD_TOKENIZER)


def op2_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(documents(spark, sf_dir), labels)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("detections")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token_store")
    token_store.write_tokens(token_store.encode_ordered(documents(spark, sf_dir), WORD_TOKENIZER, END_ID), path)
    return token_store.digest(token_store.read_tokens(spark, path))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(documents(spark, sf_dir))


def op7_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise_hash.compare_neighbours(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, BYTE_RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(documents(spark, sf_dir))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_fingerprints(documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


OP10_SQL = r"""
with plain as (
    select doc_id, length(coalesce(text, '')) as chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
    from documents
), ranked as (
    select *, first_value(doc_id) over (partition by text_sha256 order by chars desc, doc_id) as keep_id,
           count(*) over (partition by text_sha256) as group_size
    from plain
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from ranked
"""

#: Unsigned CRC-32 of the UTF-8 bytes in a list of numbers.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::ubigint, {octets}), lambda crc, octet:
    list_reduce(list_prepend(xor(crc, octet), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
                lambda rest, step: xor(rest >> 1, 3988292384::ubigint * (rest & 1)))))"""


def _netstring_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::varchar))::varchar || ':' || ({value})::varchar, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_netstring_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP12_SQL = f"""
with recursive leaves as (
    select doc_id, lang, {_leaf_sql("text")} as leaf, coalesce(({
        CRC32_SQL.format(octets="list_transform(string_split(doc_id::varchar, ''), lambda c: unicode(c)::ubigint)")
    }) % 3 = 0, false) as chosen, {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as changed
    from documents
), langs as (
    select lang, row_number() over (order by lang nulls first) - 1 as tree, count(*) over () as trees from (select distinct lang from documents)
), placed as (
    select l.*, tree, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n
    from leaves l join langs g on l.lang is not distinct from g.lang
), nodes as (
    select tree, 0 as level, pos, n, leaf as digest from placed
    union all
    select tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by pos))
    from nodes where n > 1 group by tree, level, pos // 8, n
), subroots as (
    select tree, level, digest from nodes where n = 1
), tops as (
    select 0 as level, tree as pos, trees as n, digest from subroots join langs using (tree)
    union all
    select level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by pos))
    from tops where n > 1 group by level, pos // 8, n
), every as (
    select tree, level, pos, n, digest from nodes
    union all
    select -1, level, pos, n, digest from tops
), siblings as (
    select a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as before,
           coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as after
    from every a join every b on a.tree = b.tree and a.level = b.level and a.pos // 8 = b.pos // 8
    where a.n > 1 group by a.tree, a.level, a.pos
), folds as (
    select doc_id, leaf, tree, tree as spot, 0 as level, pos, case when chosen then changed else leaf end as digest, '' as path
    from placed
    union all
    select f.doc_id, f.leaf, f.tree, case when s.pos is null then -1 else f.spot end,
           case when s.pos is null then 0 else f.level + 1 end, case when s.pos is null then f.tree else f.pos // 8 end,
           case when s.pos is null then f.digest else sha256(s.before || f.digest || s.after) end,
           f.path || coalesce(s.before || s.after, '')
    from folds f left join siblings s on s.tree = f.spot and s.level = f.level and s.pos = f.pos
    where s.pos is not null or f.spot <> -1
)
select f.doc_id, f.leaf, r.digest as subroot, t.digest as root, sha256(f.path) as proof_sha256,
       f.digest as folded_root, f.digest = t.digest as verified
from folds f join subroots r using (tree) cross join (select digest from tops where n = 1) t
where f.spot = -1 and not exists (select 1 from siblings s where s.tree = -1 and s.level = f.level and s.pos = f.pos)
"""

OP13_SQL = rf"""
with recursive runs as (
    select doc_id, run, count(*) as n, list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda c: unicode(c)) as points
    from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents)
    where length(run) >= 6 group by all
), checked as (
    select run, n, {
        CRC32_SQL.format(octets="flatten(list_transform(points, lambda p: case when p < 128 then [p] else [195, p - 64] end))::ubigint[]")
    } as h from runs
), spelled as (
    select case when h % 199 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n from checked
), words as (
    select word, sum(n)::bigint as n from spelled where length(word) >= 6 group by word having sum(n) >= 5
), gaps as (
    select word, n, left(word, i - 1) as head, substr(word, i + 1) as tail from words, unnest(range(1, length(word) + 1)) as u(i)
), near as (
    select a.word, b.word as other, b.n from gaps a join gaps b on a.head = b.head and a.tail = b.tail and a.word <> b.word and length(a.word) = length(b.word)
    union
    select a.word, b.word, b.n from gaps a join words b on a.head || a.tail = b.word
    union
    select b.word, a.word, a.n from gaps a join words b on a.head || a.tail = b.word
), best as (
    select word, count(*) as n_near, arg_min(other, (-n, other)) as other, max(n) as other_n from near group by word
), forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 5 * w.n then other end as form,
           case when other_n >= 5 * w.n then other_n end as form_n
    from words w left join best b on b.word = w.word
), chains as (
    select word, word as root, form from forms
    union all
    select c.word, f.word, f.form from chains c join forms f on f.word = c.form
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chains c on c.word = f.word and c.form is null
"""


QUERIES = (
    op1_token_counts,
    op2_wrappers,
    op3_quality,
    op4_licenses,
    op5_token_store,
    op6_near_dedup,
    op7_piecewise_hash,
    op8_byte_bpe,
    op9_mixing,
    op10_exact_dedup,
    op11_simhash,
    op12_merkle,
    op13_spelling,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracles() -> dict[str, str]:
    return {"op10_exact_dedup": OP10_SQL, "op12_merkle": OP12_SQL, "op13_spelling": OP13_SQL}
