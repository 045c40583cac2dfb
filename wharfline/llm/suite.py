"""The registered queries of the text operators and their SQL for the cross-check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.llm import decontaminate, language, line_dedup, near_dup, packing, periodic, quality, spelling, substring_dedup, token_count, tokenfile, topk, toxicity
from wharfline.llm.features import fold_of
from wharfline.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = fold_of(F.col("doc_id"), 5) != 0
    model = toxicity.train(docs.filter(learn), labels.filter(learn))
    return toxicity.score(docs, model).withColumn("held_out", fold_of(F.col("doc_id"), 5) == 0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), token_count.load_model(tokenizer("piece_bpe_32k.model")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), packing.load_model(tokenizer("word_bpe_49k.json"))).drop("ids")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = fold_of(F.col("doc_id"), 5) != 0
    model = quality.train(docs.filter(learn), labels.filter(learn))
    return quality.score(docs, model).withColumn("held_out", fold_of(F.col("doc_id"), 5) == 0)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = language.train(docs.filter(~held_out))
    out = language.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenfile.write_ids(documents(spark, sf_dir), packing.load_model(tokenizer("word_bpe_49k.json")), path)
    return tokenfile.read_ids(spark, path, with_ids=False)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(documents(spark, sf_dir), least=7)  # a run that loses a letter is 8 long
    return spelling.spelling_groups(spelling.vocabulary(spelling.with_lost_letter(runs)))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_repeated_tail(documents(spark, sf_dir).select("doc_id", "text")))
    best = periodic.strongest("runs")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (select doc_id, line, pos, {_LOWER.format(f"trim(line, {_SPACES})")} as key from lines),
common as (select key, max(doc_id) as top from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select doc_id, count(*) as n_lines, count(*) filter (top is not null and top <> doc_id) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (top is null or top = doc_id), '')) as kept_sha256
from keyed left join common using (key) group by doc_id"""

_WORDS = r"[x for x in regexp_split_to_array({}, '[\x20\x09-\x0D]+') if x <> '']"

_TOKENS = r"[x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if x <> '']"

# The rule alone, without seeds or masks: every offset at which any word of an item equals a word of the text is judged.
OP2_SQL = f"""
with d as (select doc_id, {_TOKENS} as h from documents),
b as (select h, min(item_id) as item_id, len(h) as m from (select item_id, {_TOKENS} as h from benchmark) where len(h) > 0 group by h),
dw as (select doc_id, unnest(h) as w, unnest(range(len(h))) as p from d),
bw as (select item_id, least(13, m) as n, unnest(h) as w, unnest(range(len(h))) as j from b),
offsets as (select doc_id, item_id, p - j as o, any_value(n) as n, list(j order by j) as js from dw join bw using (w)
            group by doc_id, item_id, p - j having count(*) * 100 >= 80 * any_value(n)),
runs as (select doc_id, item_id, n, list_max([len([x for x in js if x >= s and x < s + n]) for s in js]) as s from offsets)
select doc_id, item_id, cast(max(s) as int) as matched, cast(max(n) as int) as "window"
from runs where s * 100 >= 80 * n group by doc_id, item_id"""

OP6_SQL = """
with v as (select vec_id, [floor(256 * x::double) for x in embedding] as v from embeddings
           where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id as query_id, d.vec_id, cast(list_inner_product(q.v, d.v) as bigint) as score
      from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify rank <= 5"""

OP8_SQL = f"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
wins as (select doc_id, s, array_to_string(w[s + 1 : s + 50], ' ') as win from (select doc_id, w, unnest(range(greatest(0, len(w) - 49))) as s from d)),
firsts as (select win, min(doc_id) as first from wins group by win),
gone as (select distinct doc_id, unnest(range(s, s + 50)) as p from wins join firsts using (win) where first < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p from d),
kept as (select doc_id, count(*) filter (g.p is not null) as n_removed, string_agg(word, ' ' order by p) filter (g.p is null) as text
         from words left join gone g using (doc_id, p) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (doc_id)"""

OP9_SQL = f"""
with recursive d as (select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
sh as (select distinct doc_id, array_to_string(w[s + 1 : s + 3], ' ') as g
       from (select doc_id, w, unnest(range(case when len(w) = 0 then 0 else greatest(1, len(w) - 2) end)) as s from d)),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) as (select doc_id, doc_id from d union select r.a, l.b from reach r join links l on r.b = l.a),
c as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from c left join n using (doc_id)"""

# crc32 is linear: each byte adds a value that depends on it and on the number of bytes after it, each length a constant.
_CRC = """
bits(b, c, k) as (select b::bigint, b::bigint, 0 from range(256) t(b)
                  union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc_byte as (select b, c from bits where k = 8),
crc_at(d, b, v) as (select 0, b, c from crc_byte
                    union all select d + 1, a.b, xor(a.v >> 8, t.c) from crc_at a join crc_byte t on t.b = a.v & 255 where d < 200),
crc_start(d, s) as (select 0, 4294967295::bigint
                    union all select d + 1, xor(a.s >> 8, t.c) from crc_start a join crc_byte t on t.b = a.s & 255 where d < 200)"""

OP12_SQL = f"""
with recursive {_CRC},
runs as (select doc_id, w, count(*) as k from (
           select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as w from documents)
         where length(w) >= 7 group by doc_id, w),
marked as (select *, hex(doc_id || ':' || w) as x from runs),
spread as (select doc_id, w, len(x) // 2 as size, unnest(range(len(x) // 2)) as i, x from marked),
hashed as (select doc_id, w, xor(xor(bit_xor(v), any_value(s)), 4294967295) as h
           from spread join crc_at on d = size - 1 - i and b = ('0x' || substr(x, 2 * i + 1, 2))::bigint join crc_start z on z.d = size group by doc_id, w),
changed as (select case when h % 31 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, k from runs join hashed using (doc_id, w)),
v as (select word, cast(sum(k) as bigint) as n from changed where length(word) >= 7 group by word having sum(k) >= 2),
gaps as (select word, i, left(word, i) as a, substr(word, i + 2) as z from (select word, unnest(range(length(word))) as i from v)),
near as (select x.word, y.word as other from gaps x join gaps y using (i, a, z) where x.word <> y.word
         union select g.word, v.word from gaps g join v on v.word = g.a || g.z union select v.word, g.word from gaps g join v on v.word = g.a || g.z),
best as (select near.word, count(*) as n_near, first(other order by v.n desc, other) as other, max(v.n) as most from near join v on v.word = near.other group by near.word),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= 10 * v.n then other end as form, case when most >= 10 * v.n then most end as form_n
      from v left join best using (word)),
chain(word, root, depth) as (select word, word, 0 from f union all select c.word, f.form, depth + 1 from chain c join f on f.word = c.root where f.form is not null)
select word, form, (select last(root order by depth) from chain c where c.word = f.word) as root, n, n_near, form_n from f"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_topk": op6_topk,
    "op7_quality": op7_quality,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language": op10_language,
    "op11_token_files": op11_token_files,
    "op12_spelling": op12_spelling,
    "op13_periodic": op13_periodic,
}

# Models and token ids have no SQL: tests/llm holds them against brute force, the tokenizers' libraries and held-out labels.
ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op2_decontamination": OP2_SQL,
    "op6_topk": OP6_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_near_duplicates": OP9_SQL,
    "op12_spelling": OP12_SQL,
}
