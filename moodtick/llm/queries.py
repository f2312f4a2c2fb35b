"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import bpe, chat, decontaminate, language, merkle, ngrams, quality, secret_scan, simhash, substrings, surrogates, wavelet, whiten
from .common import bucket, checkpoint, read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document: what is hit, and which items."""
    found = decontaminate.matches(
        read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontaminate.items_sha256(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of every document and whether it is kept."""
    found = quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as read back from its examples, and conversation -1 full of control strings."""
    own = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{hostile}'), (-1L, 1L, 'assistant', '{hostile}') t(conv_id, turn, role, text)")
    found = chat.read_back(chat.examples(own.unionByName(extra)))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )


#: The key of the registered query and the pipeline; a user passes a secret one.
PII_KEY = "moodtick-demo-key"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for the private data in it, and how many there were."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, PII_KEY, count="n_entities")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its probability, by a forest trained on the
    findings of three quarters of the documents, labelled by how they are assigned."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    own = docs.where(bucket("doc_id", 4) != 2)
    learned = secret_scan.by_assignment(secret_scan.candidates(own, path="source"))
    model = secret_scan.train(learned, secret_scan.frequent_words(own))
    return secret_scan.scanned(docs, model, path="source")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it stands in the token files: where its ids start, how many, their crc32."""
    import public_tokenizers as P

    files = checkpoint(
        wavelet.write_shards(read(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), end=0)
    )
    return wavelet.read_shards(wavelet.with_starts(files))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    return language.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document under a model of those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    meta = ngrams.train(docs.where(~ngrams.held_out()))
    return ngrams.scored(docs, meta).select(
        "doc_id", ngrams.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and the digest of what they decode to."""
    import public_tokenizers as P

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in a manifest of all, and whether a copy with lower-cased texts
    in about a fifth of the documents passes it."""
    docs, columns = read(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    copy = merkle.digest(*[lower if c == "text" else F.col(c) for c in columns])
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle.Manifest(spark, shared_path(spark, f"merkle-{uuid.uuid4().hex}"))
    found = manifest.write(merkle.leaves(docs, columns, F.when(changed, copy))).proofs()
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("sides")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("claim", "leaf"), F.col("sides")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    found, model = whiten.whitened(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=4)
    share = [v / model.trace if model.trace else None for v in model.values.tolist()] if model else [None]
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else None).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(v).cast("double") for v in share]), F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 50 words that smaller ids have."""
    found = substrings.deduplicated(read(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_quality, op3_chat, op4_surrogates, op5_secrets, op6_token_files, op7_decontaminate, op8_language, op9_kneser_ney, op10_bpe, op11_merkle, op12_whiten, op13_substrings)}

#: DuckDB SQL of the queries that SQL can express.
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD7 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
def _escaped(c: str) -> str:
    c = f"replace({c}, chr(92), chr(92) || chr(92))"
    for s in chat.CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}' || chr(92) || '{s[1:]}')"
    return c


_RULES2 = {
    "symbols": "least(1000, 1000 * n_symbols // greatest(n_words, 1))",
    "duplicate_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeated_words": "1000 * n_repeat_words // greatest(n_words, 1)",
    "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
}
_ALLOWED = f"({quality.RISK!r} / {len(_RULES2)})"
def _digest(text: str) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


#: One level of a proof: the digests left and right of the node in its run.
_FOLDED = """sha256(array_to_string(ns[1:pos % 16], '') || node || array_to_string(ns[pos % 16 + 2:], '')),
         proof || array_to_string(ns[1:pos % 16], '') || array_to_string(ns[pos % 16 + 2:], '')"""
#: crc32 of the decimal doc_id, bit by bit.
_CRC = """list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
  lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"""
_CRC = f"xor({_CRC}, 4294967295)"
ORACLE: dict[str, str] = {
    "op2_quality": rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
gram AS (
  SELECT r, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS i FROM doc)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM gram) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
line AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM doc),
counts AS (
  SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM doc JOIN line USING (r) LEFT JOIN rep USING (r)),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
         {', '.join(f'{v} AS {k}' for k, v in _RULES2.items())} FROM counts),
label AS (
  SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
  GROUP BY doc_id HAVING min(quality) = max(quality)),
share AS (
  {' UNION ALL '.join(f"SELECT r, lang, good, '{k}' AS rule, {k} AS share FROM based JOIN label USING (doc_id)" for k in _RULES2)}),
cutoff AS (SELECT unnest([{', '.join(map(str, quality.CUTOFFS))}]) AS cutoff),
tested AS (
  SELECT lang, rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS m,
         count(*) FILTER (good AND share > cutoff) AS k, count(*) FILTER (NOT good AND share > cutoff) AS c
  FROM share, cutoff GROUP BY ALL),
tail AS (
  SELECT *, CASE WHEN k > n * {_ALLOWED} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(
    lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_ALLOWED}) + (n - i) * ln(1 - {_ALLOWED})))) END AS p,
    CASE WHEN m > 0 THEN c / m ELSE 0 END - CASE WHEN n > 0 THEN k / n ELSE 0 END AS gain
  FROM tested),
best AS (
  SELECT lang, rule, max({{'gain': gain, 'cutoff': cutoff}}).cutoff AS cutoff FROM tail
  WHERE gain > 0 AND p <= {quality.ERROR!r} / (SELECT count(*) FROM tested) GROUP BY ALL),
over AS (
  SELECT DISTINCT r FROM ({' UNION ALL '.join(f"SELECT r, lang, '{k}' AS rule, {k} AS share FROM based" for k in _RULES2)}) s
  JOIN best ON s.lang IS NOT DISTINCT FROM best.lang AND s.rule = best.rule AND share > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND over.r IS NULL AS kept
FROM based LEFT JOIN over ON based.r = over.r""",
    "op3_chat": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             count(*) OVER (PARTITION BY conv_id) AS n FROM c),
e AS (SELECT *, {_escaped('role')} AS er, {_escaped('text')} AS et FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + {len(chat.TURN + chat.SAYS + chat.END)}) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR i = n) AS n_examples
FROM e GROUP BY conv_id""",
    "op7_decontaminate": f"""
WITH item AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {_FOLD}), '{_WORD7}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item, w, k, unnest(range(1, CAST(len(w) AS BIGINT) - k + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS k FROM item WHERE len(w) > 0))),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_FOLD}), '{_WORD7}'), []) AS w FROM documents),
gram AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, CAST(len(w) AS BIGINT) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM win))),
found AS (SELECT gram.doc_id, gram.i, gram.k, win.item FROM gram JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle": rf"""
WITH RECURSIVE
doc AS (
  SELECT doc_id, source, {_digest('text')} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_digest(f"translate(text, {_FOLD})")} ELSE {_digest('text')} END AS claim FROM documents),
src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM doc GROUP BY source),
leafs AS (
  SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, doc_id, leaf, claim
  FROM doc JOIN src ON doc.source IS NOT DISTINCT FROM src.source),
lv AS (
  SELECT 0 AS l, tree, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM leafs
  UNION ALL
  SELECT l + 1, tree, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (n + 15) // 16 FROM lv WHERE n > 1
  GROUP BY l, tree, pos // 16, n),
sub AS (SELECT tree, node FROM lv WHERE n = 1),
rv AS (
  SELECT 0 AS l, tree AS pos, node, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT l + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (n + 15) // 16 FROM rv WHERE n > 1
  GROUP BY l, pos // 16, n),
run AS (SELECT l, tree, pos // 16 AS r, list(node ORDER BY pos) AS ns FROM lv WHERE n > 1 GROUP BY ALL),
top AS (SELECT l, pos // 16 AS r, list(node ORDER BY pos) AS ns FROM rv WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT tree, pos AS leaf_pos, doc_id, leaf, 0 AS l, pos, claim AS node, '' AS proof FROM leafs
  UNION ALL
  SELECT up.tree, leaf_pos, doc_id, leaf, up.l + 1, pos // 16, {_FOLDED}
  FROM up JOIN run ON run.l = up.l AND run.tree = up.tree AND run.r = pos // 16),
mid AS (SELECT tree, leaf_pos, arg_max(struct_pack(doc_id, leaf, node, proof), l) AS x FROM up GROUP BY ALL),
over AS (
  SELECT tree, leaf_pos, x.doc_id AS doc_id, x.leaf AS leaf, 0 AS l, tree AS pos, x.node AS node, x.proof AS proof FROM mid
  UNION ALL
  SELECT tree, leaf_pos, doc_id, leaf, over.l + 1, pos // 16, {_FOLDED}
  FROM over JOIN top ON top.l = over.l AND top.r = pos // 16),
done AS (SELECT tree, leaf_pos, arg_max(struct_pack(doc_id, leaf, node, proof), l) AS x FROM over GROUP BY ALL)
SELECT x.doc_id AS doc_id, x.leaf AS leaf, sub.node AS subroot, root.node AS root, sha256(x.proof) AS proof_sha256,
       x.node AS folded_root, x.node = root.node AS verified
FROM done JOIN sub USING (tree), (SELECT node FROM rv WHERE n = 1) root""",
    "op13_substrings": r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT *, unnest(range(1, CAST(len(w) AS BIGINT) - 48)) AS i FROM doc)),
again AS (SELECT r, i FROM win JOIN (SELECT g, min(doc_id) AS least FROM win GROUP BY g) USING (g) WHERE doc_id IS NULL AND least IS NOT NULL OR least < doc_id),
gone AS (SELECT r, list(DISTINCT p) AS p FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM again) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(p, i)) END, ' ')) AS kept_sha256
FROM doc LEFT JOIN gone USING (r)""",
}
