"""The registered queries of the training-data operators: name -> (function, SQL).

Each query applies one operator with production parameters to its whole table
and derives the digest columns of its contract. SQL is None where SQL cannot
express the operator; those are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

#: Vocabulary file of the token operators.
VOCABULARY = "word_bpe_49k.json"


def register(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return add


@register("op1_wrapper_extraction")
def op1_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page along the wrapper of its host."""
    from tidewater.llm.wrappers import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages"))


@register("op4_pruned_graph_neighbours")
def op4_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 nearest of every embedding whose id is divisible by 100."""
    from tidewater.llm.vamana import nearest
    return nearest(table(spark, sf_dir, "embeddings"), k=10)


@register("op5_wavelet_tokens")
def op5_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document through wavelet-matrix files (end id 1)."""
    from tidewater.llm.tokens import vocabulary_path
    from tidewater.llm.wavelet import read_documents, write_shards
    return read_documents(write_shards(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY), end_id=1))


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids (end id 0)."""
    from tidewater.llm.packing import pack_documents
    from tidewater.llm.tokens import vocabulary_path
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY), end_id=0, capacity=2048)


_WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


@register("op2_fm_index_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN win ON dw.n = win.n AND dw.s = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS s
        FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op2_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document, by FM-index."""
    from tidewater.llm.fm_index import find_contamination
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .drop("items", "spans")


@register("op3_simhash_trie")
def op3_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 2 bits."""
    from tidewater.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, budget=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op6_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, CAST(len(h) // 2 AS BIGINT) AS n FROM d),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
      FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w)
      WHERE k > 1),
e AS (SELECT doc_id, p, coalesce(p > 100 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), TRUE) AS fresh FROM r),
g AS (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM e),
spans AS (SELECT doc_id, k, min(p) AS s, max(p) + 100 AS t FROM g GROUP BY doc_id, k),
gaps AS (
  SELECT doc_id, coalesce(lag(t) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS z FROM spans
  UNION ALL SELECT b.doc_id, max(t), any_value(n) FROM spans JOIN b ON spans.doc_id = b.doc_id GROUP BY b.doc_id),
kept AS (SELECT gaps.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h
         FROM gaps JOIN b ON gaps.doc_id = b.doc_id GROUP BY gaps.doc_id),
tot AS (SELECT doc_id, sum(t - s) AS m, count(*) AS c FROM spans GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, CAST(coalesce(m, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256
FROM b LEFT JOIN tot ON tot.doc_id = b.doc_id LEFT JOIN kept ON kept.doc_id = b.doc_id""")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier, cut out."""
    from tidewater.llm.suffix_dedup import repeat_digest
    return repeat_digest(table(spark, sf_dir, "documents"))


@register("op9_kneser_ney_quality")
def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under trusted text, and whether it is kept."""
    from tidewater.llm.kneser_ney import judge
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_segment_toxicity")
def op10_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of rows with remainder 1 are held out."""
    from tidewater.llm.toxicity import score_documents
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.expr("pmod(crc32(cast(doc_id AS string)), 3) = 1")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"))


@register("op8_label_propagation")
def op8_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards, counts at most one apart, equal texts together."""
    from tidewater.llm.sharding import assign_shards
    return assign_shards(table(spark, sf_dir, "documents"), shards=8)


#: crc32 of a row's key in SQL, bit by bit.
_DEALT_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20"""


def _moved(state: str, cost: str, letters: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}'}}"


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


_INSERTED_SQL = f"""v0 AS w0, v1 AS w1,
    {_least('v2', _moved('v0', '5', 'I'), _moved('v1', '5', 'I'), _moved('v3', '5', 'I'))} AS w2,
    {_least('v3', _moved('v0', '10', 'II'), _moved('v1', '10', 'II'), _moved('v2', '5', 'I'))} AS w3"""


def _stays(state: str, initial: str | None, letter: str) -> str:
    """A way that is closed (cost a million) for rows that must go or have another role."""
    shut = "f IN ('b', 'd')" + (f" OR r <> '{initial}'" if initial else "")
    cost = f"CASE WHEN {shut} THEN 1000000 ELSE {1 if letter == 'R' else 0} + CASE f WHEN 't' THEN 5 ELSE 0 END END"
    return _moved(state, cost, letter)


@register("op11_grammar_repair", f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_DEALT_SQL} AS dealt FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE WHEN dealt = 4 THEN 'user' ELSE role END AS role,
    CASE dealt WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN dealt = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE dealt <> 0),
num AS (
  SELECT *, left(role, 1) AS r,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen
  FROM dam),
flt AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen THEN 'd'
    WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN '' ELSE 't' END AS f
  FROM num),
vec AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': ''}} AS v0, {{'c': 1000000, 'a': ''}} AS v1,
    {{'c': 1000000, 'a': ''}} AS v2, {{'c': 1000000, 'a': ''}} AS v3 FROM conversations
  UNION ALL
  SELECT conv_id, i, {_moved('w0', '2', 'D')},
    {_least(_moved('w1', '2', 'D'), _stays('w0', 's', 'K'))},
    {_least(_moved('w2', '2', 'D'), *[_stays(w, *how) for w in ('w0', 'w1', 'w3') for how in (('u', 'K'), (None, 'R'))])},
    {_least(_moved('w3', '2', 'D'), _stays('w2', 'a', 'K'), _stays('w2', None, 'R'))}
  FROM (SELECT flt.conv_id, flt.i, r, f, {_INSERTED_SQL}
        FROM vec JOIN flt ON vec.conv_id IS NOT DISTINCT FROM flt.conv_id AND flt.i = vec.i + 1)),
fin AS (
  SELECT conv_id, i AS n, {_least('v0', 'v3', _moved('v0', '10', 'II'), _moved('v1', '10', 'II'), _moved('v2', '5', 'I'))} AS best
  FROM vec QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
ops AS (
  SELECT conv_id, p, best.a[p] AS op, sum((best.a[p] <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS i
  FROM (SELECT conv_id, best, unnest(range(1, len(best.a) + 1)) AS p FROM fin)),
outp AS (
  SELECT ops.conv_id, p, op, flt.role, flt.r, CASE op WHEN 'I' THEN '' ELSE flt.text END AS text,
    row_number() OVER (PARTITION BY ops.conv_id ORDER BY p) AS k,
    first_value(op = 'K' AND flt.r = 's') OVER (PARTITION BY ops.conv_id ORDER BY p) AS has_s
  FROM ops LEFT JOIN flt ON ops.conv_id IS NOT DISTINCT FROM flt.conv_id AND ops.i = flt.i WHERE op <> 'D'),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (k - has_s::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY p) AS s FROM outp GROUP BY conv_id),
pairs AS (SELECT conv_id, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS rr FROM flt),
bad AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE rr IS NOT NULL AND rr NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
tot AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated FROM flt GROUP BY conv_id)
SELECT fin.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(coalesce(s, '')) AS repaired_sha256
FROM fin LEFT JOIN tot ON tot.conv_id IS NOT DISTINCT FROM fin.conv_id
LEFT JOIN bad ON bad.conv_id IS NOT DISTINCT FROM fin.conv_id LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM fin.conv_id""")
def op11_grammar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a fixed rule, repaired at least cost."""
    from tidewater.llm.conversation_repair import repair
    given = table(spark, sf_dir, "conversations")
    return repair(damaged(given), given)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: by crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its
    text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    dealt = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                                 (F.crc32(key.cast("binary")) % 20).alias("__dealt")).filter("__dealt <> 0")
    text = F.when(F.col("__dealt") == 1, "").when(F.col("__dealt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("__dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return dealt.select("conv_id", "turn", F.when(F.col("__dealt") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(copies).alias("__copy")).drop("__copy")


@register("op12_fuse_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ 	-]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""")
def op12_fuse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents; one half is an established snapshot, the other half arrives."""
    from tidewater.llm.fuse_dedup import deduplicate
    return deduplicate(table(spark, sf_dir, "documents"), F.pmod(F.xxhash64("doc_id"), F.lit(2)), arrivals=2)


@register("op13_qd_whitening")
def op13_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading components, whitened."""
    from tidewater.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"), components=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
