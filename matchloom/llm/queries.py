"""Registered training-data queries: each maps a given table to an operator and its result back."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import (
    benchmark_leaks,
    dialogue_views,
    match_manifest,
    page_archive,
    page_language,
    page_overlap,
    page_quality,
    page_shards,
    player_neighbours,
    profile_whitening,
    repeated_passages,
    site_lines,
    token_packing,
)
from matchloom.session import Workspace, tune

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        LLM_QUERIES[name] = lambda spark, sf_dir: run(tune(spark), sf_dir.rstrip("/"))
        if sql is not None:
            LLM_EXPECTED[name] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_texts(documents: DataFrame) -> DataFrame:
    """The given documents as the library's page texts."""
    return documents.select(F.col("doc_id").cast("long").alias("match_id"), F.col("source").alias("site"),
                            F.col("lang").alias("language"), F.col("text").alias("page_text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "documents"))


@query("op1_warc", """
with r as (
  select page_id, coalesce(encode(html), ''::blob) payload from pages),
k as (
  select page_id, octet_length(payload)::bigint payload_bytes, sha1(payload) payload_digest from r),
h as (
  select payload_digest, max(page_id) holder from k where payload_bytes >= 1000 group by 1)
select k.page_id, payload_bytes, k.payload_digest,
       case when holder <> page_id then 'revisit' else 'response' end record_type,
       case when holder <> page_id then holder end refers_to
from k left join h on h.payload_digest = k.payload_digest and payload_bytes >= 1000""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op1")
    folder = work.path("archives")
    index = page_archive.write_archives(table(spark, sf_dir, "pages"), work, folder)
    return page_archive.read_archives(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def hash_rest(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; null ids belong to no part."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


@query("op2_page_quality")
def op2_page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op2")
    pages = documents(spark, sf_dir)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("match_id"), F.col("quality").alias("data_complete"))
    model = page_quality.fit_quality(pages, outcomes.where(hash_rest("match_id", 4) != 2), work)
    return page_quality.score_quality(pages, model).select(
        F.col("match_id").alias("doc_id"), F.coalesce(hash_rest("match_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))


@query("op3_page_language")
def op3_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir)
    model = page_language.fit_languages(pages.where(hash_rest("match_id", 5) != 0))
    return page_language.guess_languages(pages, model).select(
        F.col("match_id").alias("doc_id"), F.coalesce(hash_rest("match_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("language_pred").alias("lang_pred"), F.col("share").alias("score"))


@query("op4_repeated_spans", r"""
with d as (select doc_id, text, regexp_extract_all(text, '(?s).+?(?:[.!?]+[ \t\r\n]+|\n+|\z)') pieces from documents),
p as (select doc_id, text, unnest(pieces) piece, generate_subscripts(pieces, 1) i from d),
k as (select doc_id, i, lower(trim(piece, chr(32) || chr(9) || chr(13) || chr(10))) key from p),
w as (select doc_id, i, key, len(string_split_regex(key, '[ \t\r\n]+')) words from k),
c as (select *, sum(words) over (partition by doc_id order by i) upto from w),
pairs as (select a.doc_id, a.i i, b.i j from c a join c b on a.doc_id = b.doc_id and b.i between a.i + 1 and a.i + 19
          and b.upto - a.upto + a.words >= 20),
spans as (select doc_id, i, min(j) j from pairs group by doc_id, i union select doc_id, max(i), j from pairs group by doc_id, j),
keys as (select doc_id, list(key order by i) keys from k group by 1),
n as (select doc_id, i, j, row_number() over (partition by keys[i:j] order by doc_id, i) occurrence from spans join keys using (doc_id)),
gone as (select distinct doc_id, unnest(range(i, j + 1)) i from n where occurrence > 1),
kept as (select p.doc_id, string_agg(piece, '' order by p.i) filter (where g.i is null) text, count(g.i) n_removed
         from p left join gone g on g.doc_id = p.doc_id and g.i = p.i group by 1)
select d.doc_id, case when coalesce(n_removed, 0) = 0 then d.text else coalesce(kept.text, '') end as text,
       coalesce(len(pieces), 0)::bigint n_sentences, coalesce(n_removed, 0)::bigint n_removed
from d left join kept using (doc_id)""")
def op4_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sentences or more that hold 20 words; shorter repeats are often chance."""
    work = Workspace(spark, "op4")
    return repeated_passages.drop_repeated_passages(documents(spark, sf_dir), work, run=2, min_words=20, extend=True).withColumnsRenamed(
        {"match_id": "doc_id", "page_text": "text"})


@query("op5_site_lines", """
with d as (select doc_id, coalesce(source, '') site, text, string_split(text, chr(10)) lines from documents),
t as (select site, count(*) total from d group by 1),
l as (select site, unnest(list_distinct(list_transform(lines, lambda x: trim(x, chr(32) || chr(9) || chr(13))))) line from d),
b as (select l.site, line from l join t using (site) where line <> '' group by l.site, line, total
      having count(*) >= 5 and count(*) > 0.1 * total),
s as (select site, list(line) boilerplate from b group by 1),
k as (select doc_id, text, lines, list_filter(lines, lambda x: not coalesce(list_contains(boilerplate, trim(x, chr(32) || chr(9) || chr(13))), false)) kept
      from d left join s using (site))
select doc_id, case when text is null then null else array_to_string(kept, chr(10)) end as text,
       coalesce(len(lines), 0)::bigint n_lines, coalesce(len(lines) - len(kept), 0)::bigint n_dropped from k""")
def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op5")
    return site_lines.drop_site_lines(documents(spark, sf_dir), work).withColumnsRenamed(
        {"match_id": "doc_id", "page_text": "text"})


@query("op6_benchmark_leaks")
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    return benchmark_leaks.find_leaks(documents(spark, sf_dir), passages).withColumnsRenamed({"match_id": "doc_id"})


@query("op7_page_overlap", r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') words from documents),
s as (select doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 3, 1) + 1),
        lambda i: array_to_string(words[i:i + 3], ' '))) shingles from w where len(words) > 0),
e as (select doc_id, len(shingles) n, unnest(shingles) shingle from s),
links as (select a.doc_id a, b.doc_id b from e a join e b on a.shingle = b.shingle and a.doc_id <> b.doc_id
          group by 1, 2, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select doc_id a, doc_id b from s union select r.a, l.b from reach r join links l on l.a = r.b)
select doc_id, coalesce(len(shingles), 0)::bigint n_shingles, coalesce(m.smallest, doc_id) component_id
from documents left join s using (doc_id) left join (select a, min(b) smallest from reach group by 1) m on m.a = doc_id""")
def op7_page_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op7")
    return page_overlap.page_groups(documents(spark, sf_dir), work, words=4, percent=85).select(
        F.col("match_id").alias("doc_id"), "n_shingles", F.col("group_id").alias("component_id"))


VOCABULARY = "word_bpe_49k.json"


@query("op8_token_packing")
def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_packing.pack_pages(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return pieces.select(F.col("match_id").alias("doc_id"), "start", "length", F.crc32("token_ids").alias("ids_crc32"),
                         F.col("page_tokens").alias("doc_tokens"), "sequence_id", "offset")


@query("op9_player_neighbours")
def op9_player_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op9")
    profiles = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("player_id"), F.col("embedding").alias("profile"))
    found = player_neighbours.similar_players(profiles, profiles.where(F.col("player_id") % 50 == 0), work, k=5)
    return found.select(F.col("player_id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("similar_id").alias("vec_id"), "score")


@query("op10_dialogue_views", """
with d as (select distinct conv_id, coalesce(turn, -1) turn, coalesce(role, 'unknown') speaker, coalesce(text, '') text from conversations),
t as (select *, row_number() over (partition by conv_id order by turn, md5(speaker) || md5(text)) - 1 number from d),
p as (select distinct conv_id, speaker perspective from t where speaker <> 'system'),
s as (select t.conv_id, perspective, number, number // 64 part, speaker = perspective own,
        case when speaker = perspective then '<|assistant|>' when speaker = 'system' then '<|system|>'
             else concat('<|user name=', speaker, '|>') end || chr(10) head,
        text || '<|end|>' body
      from t join p on t.conv_id is not distinct from p.conv_id),
o as (select *, coalesce(sum(length(head) + length(body) + 1) over (
        partition by conv_id, perspective, part order by number rows between unbounded preceding and 1 preceding), 0) + length(head) begins
      from s)
select conv_id, perspective, part, count(*) n_turns, string_agg(head || body || chr(10), '' order by number) rendered,
       coalesce(string_agg(case when own then concat(begins::bigint, '-', (begins + length(body))::bigint) end, ',' order by number), '') loss_spans
from o group by 1, 2, 3""")
def op10_dialogue_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op10")
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("role", "speaker")
    spans = F.transform("loss_spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return dialogue_views.perspective_views(turns, work).withColumn("loss_spans", F.array_join(spans, ","))


# The table for one byte of a CRC-32, from its polynomial.
CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), i::bigint)) crcs"""


def crc32_sql(blob: str) -> str:
    """Unsigned CRC-32 of a blob; ``crcs`` must be in scope."""
    octets = f"list_transform(range(octet_length({blob})), lambda k: ('0x' || substr(hex({blob}), (2 * k + 1)::bigint, 2))::bigint)"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295)"


@query("op11_page_shards", f"""
with crc as ({CRC_TABLE}),
d as (select doc_id, encode(coalesce(text, '')) payload, coalesce(md5(text), '') digest from documents),
r as (select doc_id, octet_length(payload)::bigint + 16 size, {crc32_sql("payload")} text_crc32, digest from d, crc),
p as (select *, row_number() over o - 1 number, sum(size) over o - size before, sum(size) over () total, sum(size) over (partition by digest) held
      from r window o as (order by digest, doc_id nulls first rows between unbounded preceding and current row)),
s as (select *, case when held * 4000 > 2 * total then 2 * before + size else 2 * min(before) over (partition by digest) + held end middle from p),
c as (select *, (middle * 40 // (2 * total))::int shard from s)
select doc_id, size, text_crc32::bigint text_crc32, 'bytes' law, shard, (number - min(number) over (partition by shard))::bigint slot,
       null::int grown_shard from c""")
def op11_page_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op11")
    pages = documents(spark, sf_dir).select(F.col("match_id").alias("page_id"), F.col("page_text").alias("html"))
    return page_shards.shard_pages(pages, work, shards=40).select(
        F.col("page_id").alias("doc_id"), F.col("page_bytes").alias("size"), F.col("page_crc32").alias("text_crc32"),
        F.lit(page_shards.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op12_profile_whitening")
def op12_profile_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op12")
    profiles = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("player_id"), F.col("embedding").alias("profile"))
    return profile_whitening.whiten_profiles(profiles, work, components=16).withColumnsRenamed(
        {"player_id": "vec_id", "n_profiles": "n"})


def field_sql(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar, '-')"


@query("op13_match_manifest", f"""
with recursive crc as ({CRC_TABLE}),
d as (select doc_id, source, sha256({" || ".join(field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) leaf,
        sha256({" || ".join(field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "copy"))}) claimed
      from (select *, case when {crc32_sql("encode(doc_id::varchar)")} % 2 = 0 then replace(text, chr(10), '') else text end copy from documents, crc)),
p as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 place, count(*) over (partition by source) size,
        dense_rank() over (order by source nulls first) - 1 tree from d),
up as (select tree, 0 level, place, size, leaf digest from p
       union all
       select tree, level + 1, place // 3, (max(size) + 2) // 3, sha256(string_agg(digest, '' order by place)) from up where size > 1 group by tree, level, place // 3),
steps as (select tree, level, place, size, digest,
            coalesce(string_agg(digest, '' order by place) over (run rows between unbounded preceding and 1 preceding), '') before,
            coalesce(string_agg(digest, '' order by place) over (run rows between 1 following and unbounded following), '') after
          from up window run as (partition by tree, level, place // 3 order by place)),
subroots as (select tree, digest subroot from up where size = 1),
top as (select 0 level, tree place, (select count(*) from subroots) size, subroot digest from subroots
        union all
        select level + 1, place // 3, (max(size) + 2) // 3, sha256(string_agg(digest, '' order by place)) from top where size > 1 group by level, place // 3),
top_steps as (select level, place, size, digest,
            coalesce(string_agg(digest, '' order by place) over (run rows between unbounded preceding and 1 preceding), '') before,
            coalesce(string_agg(digest, '' order by place) over (run rows between 1 following and unbounded following), '') after
          from top window run as (partition by level, place // 3 order by place)),
climb as (select tree, place leaf_place, 0 level, place, claimed node, '' path from p
          union all
          select c.tree, leaf_place, c.level + 1, c.place // 3, sha256(before || node || after), path || before || after
          from climb c join steps s on s.tree = c.tree and s.level = c.level and s.place = c.place where s.size > 1),
half as (select c.* from climb c join (select tree, max(level) level from up group by tree) using (tree, level)),
climb2 as (select tree, leaf_place, 0 level, tree place, node, path from half
           union all
           select c.tree, leaf_place, c.level + 1, c.place // 3, sha256(before || node || after), path || before || after
           from climb2 c join top_steps s on s.level = c.level and s.place = c.place where s.size > 1),
folded as (select tree, leaf_place place, node folded_root, path from climb2 where level = (select max(level) from top))
select doc_id, leaf, subroot, digest root, sha256(path) proof_sha256, folded_root, folded_root = digest verified
from p join folded using (tree, place) join subroots using (tree), (select digest from top where size = 1)""")
def op13_match_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op13")
    matches = table(spark, sf_dir, "documents").withColumnsRenamed({"doc_id": "match_id", "source": "event"})
    tampered = F.when(F.crc32(F.col("match_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = match_manifest.match_manifest(matches, work, fields=("match_id", "event", "lang", "n_chars", "text"), claims={"text": tampered})
    folded = found.withColumn("folded_root", match_manifest.fold(F.col("claimed_leaf"), F.col("path")))
    return folded.select(F.col("match").alias("doc_id"), "leaf", "subroot", "root", match_manifest.path_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
