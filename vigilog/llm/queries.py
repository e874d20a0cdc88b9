"""The registered queries of the operators and their SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.llm import bestfit, chat, chunks, language, lexical, minhash, mixing, packing, polytope, sharding, topk, toxicity, variants
from vigilog.llm.frame import word_count
from vigilog.llm.vectors import usable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of doc_id as text, modulo ``n``; null for a null id, which is then neither learned from nor held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def toxicity_model(spark, sf_dir, docs: DataFrame) -> dict:
    """Learned without the held-out rows."""
    labels = table(spark, sf_dir, "labels").where(remainder(3) != 1)
    return toxicity.learn(toxicity.labelled(docs.select("doc_id", "text"), labels), "_text", "_label")


@query
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = toxicity.with_scores(docs, toxicity_model(spark, sf_dir, docs))
    return judged.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted", "hits")


@query
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.where(remainder(4) != 2))
    judged = language.with_language(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op3_chat_windows(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.learned_text(chat.own_turns(chat.windows(turns)))
    said_of = F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select(
        "conv_id", F.size("own").alias("n"), F.length("text").alias("chars"),
        F.struct("cell", "window", said_of.alias("said"), F.array_join("learned", "").alias("learned")).alias("part"),
    )
    # The contract's digests cover a conversation, so its parts meet here, and only here.
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts"))
    said, learned = F.array_join("parts.said", ""), F.array_join("parts.learned", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLES["op3_chat_windows"] = r"""
with recursive t as (
 select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all select -7, turn, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(turn, role)),
e as (
 select *, 23 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(replace(replace(role, '\', '\\'), '<|', '<\|')) as chars,
  cast(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) as bigint) + 3 as tokens,
  row_number() over (partition by conv_id order by turn, role, text) - 1 as pos from t),
s as (
 select *, sum(tokens) over (partition by conv_id order by pos) - tokens as start,
  max(case when pos = 0 and role = 'system' then tokens end) over (partition by conv_id) as system_tokens,
  max(case when pos = 0 and role = 'system' then chars end) over (partition by conv_id) as system_chars from e),
g as (
 select conv_id, pos, pos as lead, start + greatest(1, 768 - coalesce(system_tokens, 0)) as until from s where pos % 64 = 0
 union all
 select s.conv_id, s.pos, case when s.start + s.tokens > g.until then s.pos else g.lead end,
  case when s.start + s.tokens > g.until then s.start + greatest(1, 768 - coalesce(s.system_tokens, 0)) else g.until end
 from g join s on s.conv_id = g.conv_id and s.pos = g.pos + 1 where s.pos % 64 <> 0),
l as (select s.* from g join s on s.conv_id = g.conv_id and s.pos = g.pos where g.pos = g.lead),
c as (
 select conv_id, sum(chars) as chars from (
  select conv_id, coalesce(system_chars, 0) as chars from l where pos > 0
  union all
  select l.conv_id, h.chars from l join s h on h.conv_id = l.conv_id and h.pos < l.pos and h.pos >= l.pos - 2
   and l.start - h.start <= 256 and (h.pos > 0 or l.system_tokens is null)) group by conv_id)
select s.conv_id, cast(count(*) as bigint) as n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
 cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
 cast(sum(s.chars) + coalesce(any_value(c.chars), 0) as bigint) as formatted_chars
from s left join c on c.conv_id = s.conv_id group by s.conv_id
"""


def word_tokenizer() -> str:
    """The tokenizer that the contract names; operators take its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_inner_products(spark, sf_dir):
    # From 2^52 on a double is whole, and beyond the longs floor() would not keep it.
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
    scaled = F.transform("embedding", lambda x: whole(x.cast("double") * 256))
    # Such vectors go before the scaling; components from 7e305 on, whose 256-fold no double holds, after it.
    vectors = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"))).select("vec_id", scaled.alias("vector"))
    return topk.top_inner_products(vectors, vectors.where("vec_id % 50 = 0"))


ORACLES["op4_inner_products"] = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as vector from embeddings
 where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
e as (select vec_id, unnest(vector) as x, unnest(range(len(vector))) as i, len(vector) as n from v),
s as (select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score from e q join e c on c.i = q.i and c.n = q.n and c.vec_id <> q.vec_id
 where q.vec_id % 50 = 0 group by 1, 2)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""


@query
def op5_near_vectors(spark, sf_dir):
    return polytope.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", "n_links", "component_id", "kept")


@query
def op6_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, word_tokenizer()).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op7_repeats(spark, sf_dir):
    return chunks.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_shards(spark, sf_dir):
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("same"),
    )
    placed = sharding.even_shards(docs, F.col("same"), F.col("size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op10_near_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op11_lexical_search(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_lexical_search"] = r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
n as (select doc_id, cast(len(terms) as bigint) as n from d where len(terms) > 0),
s as (select count(*) as docs, cast(sum(n) as bigint) as length from n),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
p as (select doc_id, term, count(*) as tf from (select doc_id, unnest(terms) as term from d) where term in (select term from q) group by doc_id, term),
w as (select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w from p, s group by term, docs),
r as (select item_id, p.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * docs) // length))))) as bigint) as score
 from q join p using (term) join w using (term) join n using (doc_id), s group by item_id, p.doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r where score > 0) where rank <= 10
"""


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


# The checksum is worked out byte by byte over its table of 256 values.
ORACLES["op12_spelling_variants"] = r"""
with recursive table_ as (select list(c order by b) as t from (select b, list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as c from range(256) r(b))),
r as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents),
l as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from r where length(run) >= 6 group by all),
b as (select *, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from l),
c as (select run, n, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint)),
  lambda c, y: xor(c >> 8, t[1 + (xor(c, y) & 255)]), 4294967295), 4294967295) as h from b, table_),
w as (select word, cast(sum(n) as bigint) as n from
 (select case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as integer)) || substr(run, cast(h % length(run) as integer) + 2) else run end as word, n from c)
 where length(word) >= 6 group by word having sum(n) >= 5),
k as (select word, n, unnest(range(1, length(word) + 1)) as i from w),
s as (select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as b from k),
p as (select x.word, y.word as near, y.n as near_n from s x join s y on x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
 union select s.word, w.word, w.n from s join w on w.word = s.a || s.b
 union select w.word, s.word, s.n from s join w on w.word = s.a || s.b),
f as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as form, max(near_n) as form_n from p group by word),
g as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * n then form end as form, case when form_n >= 5 * n then form_n end as form_n from w left join f using (word)),
t as (select word, word as at, form from g union all select t.word, t.form, g.form from t join g on g.word = t.form where t.form is not null)
select g.word, g.form, t.at as root, g.n, cast(g.n_near as bigint) as n_near, g.form_n from g join t using (word) where t.form is null
"""


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op13_best_fit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = bestfit.pieces(docs, byte_tokenizer()).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return bestfit.place(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
