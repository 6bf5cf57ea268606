"""Registered queries of the operators: the thin ``opN_`` contracts, with DuckDB
SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide.llm import (exact_dedup, fingerprints, manifest, mixing, piece_coding, pseudonyms, quality, repeats, sharding, shingle_join, spelling,
                         toxicity, url_filter)
from voxtide.llm.common import read

#: Host words that put a page's URL on the list of op3.
LISTED_WORDS = ("casino", "bets", "pills", "adult", "spam")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 5-word shingles at a Jaccard similarity of 0.8 or more."""
    return shingle_join.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def piece_model() -> str:
    """Place of the public 32k piece model."""
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op2_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents and their decoding, as digests."""
    return piece_coding.digests(read(spark, sf_dir, "documents"), piece_model())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL verdicts of all pages.  The listed URLs are the canonical URLs of the
    pages whose host holds one of ``LISTED_WORDS``."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    listed = pages.where(host.rlike("|".join(LISTED_WORDS))).select(url_filter.canonical(host, path).alias("canonical"))
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    return url_filter.filter_urls(pages, rules, listed)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of the same normalised text in all documents."""
    rows = exact_dedup.dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document under the target weights 1, 2, 3."""
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes."""
    rows = sharding.shard(read(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_OWN_KEYS: dict[str, bytes] = {}


def pii_key(spark: SparkSession) -> bytes:
    """The key in the setting ``voxtide.pii.key`` (a longer one by its digest).
    Without the setting, a random key that only this application knows: its
    pseudonyms link values within the application, and nobody can undo them later."""
    given = spark.conf.get("voxtide.pii.key", None)
    if given:
        key = given.encode()
        return key if len(key) <= 64 else hashlib.blake2b(key).digest()
    return _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal values replaced by linked pseudonyms (key: see
    ``pii_key``)."""
    return pseudonyms.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), pii_key(spark))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings that a smaller document has."""
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents under a model of the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents under a field fitted to the quality labels."""
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they
    and those of the next document are."""
    return fingerprints.compared(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents (some damaged), their near words, forms and roots."""
    return spelling.group_variants(read(spark, sf_dir, "documents"), spelling.damage)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents with a tree per language, and what each row's
    proof says of the row after some were tampered with."""
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    tampered = F.when(changed, manifest.leaf_of(n_chars=F.col("n_chars") + 1))
    rows = manifest.manifest(read(spark, sf_dir, "documents"), tampered=tampered)
    rows = rows.withColumn("folded_root", manifest.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {q.__name__: q for q in (op1_ngram_jaccard, op2_piece_coding, op3_url_filter, op4_exact_dedup, op5_source_mix, op6_sharding, op7_pseudonyms, op8_repeats, op9_toxicity, op10_quality_rules,
                                   op11_fingerprints, op12_spelling, op13_manifest)}

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
_SPACE = "[\\x20\\x09-\\x0D]+"
_WORD = "[^\\x20\\x09-\\x0D]+"

OP3_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
plain AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') AS canonical FROM urls),
rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS nth
  FROM (SELECT DISTINCT host, path FROM plain) p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
listed AS (SELECT DISTINCT canonical FROM plain WHERE regexp_matches(host, '{"|".join(LISTED_WORDS)}'))
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM plain p LEFT JOIN (SELECT * FROM fits WHERE nth = 1) f ON p.host = f.host AND p.path = f.path
LEFT JOIN listed l ON p.canonical = l.canonical
"""

OP4_SQL = f"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM n WINDOW same AS (PARTITION BY text_sha256)
"""

OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         row_number() OVER (PARTITION BY doc_id ORDER BY source IS NOT NULL, encode(coalesce(source, '')), coalesce(md5(text), '')) - 1 AS nth FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1) % {len(mixing.WEIGHTS)} + 1 AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER pour AS place, sum(source_size) OVER () AS total,
         sum(source_size * {mixing.CAP}) OVER pour - source_size * {mixing.CAP} AS fixed, sum(weight) OVER () - (sum(weight) OVER pour - weight) AS open
  FROM s WINDOW pour AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT *, (total - fixed)::DOUBLE / open::DOUBLE AS level FROM o),
cut AS (SELECT level FROM lv WHERE weight * level <= source_size * {mixing.CAP} ORDER BY place LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN weight * cut.level > source_size * {mixing.CAP} THEN (source_size * {mixing.CAP})::DOUBLE ELSE weight * cut.level END AS target FROM lv, cut),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, {mixing.CAP}.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM t),
w AS (
  SELECT d.doc_id, d.size, r.source, r.source_size, r.target, r.rate, k.seed,
         ('0x' || substr(md5(k.seed::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, 'null') || CASE WHEN d.nth > 0 THEN ':' || d.nth ELSE '' END), 1, 13))::BIGINT / {mixing._DRAW} < r.rate - floor(r.rate) AS more
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source CROSS JOIN range({mixing.SEEDS}) k(seed)),
b AS (
  SELECT source, seed, abs(sum(CASE WHEN more THEN size ELSE 0 END) + any_value(floor(rate) * source_size) - any_value(target)) AS gap FROM w GROUP BY source, seed),
c AS (SELECT source, arg_min(seed, (gap, seed)) AS seed FROM b GROUP BY source)
SELECT w.doc_id, w.size, w.source_size, w.target, (w.size * (floor(w.rate)::BIGINT + w.more::INT))::BIGINT AS taken
FROM w JOIN c ON w.source IS NOT DISTINCT FROM c.source AND w.seed = c.seed
"""

#: CRC-32 (reversed polynomial EDB88320) of the list ``bytes``, bit by bit.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
        "lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)")

OP12_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
one AS (SELECT doc_id, run, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS said FROM raw GROUP BY ALL),
told AS (SELECT doc_id, run, n, list_transform(range(octet_length(said)), lambda i: ('0x' || substr(hex(said), 2 * i + 1, 2))::BIGINT) AS bytes FROM one),
summed AS (SELECT run, n, {_CRC} AS h FROM told),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
gone AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, encode(other), other)) AS top FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -top[1] >= {spelling.FACTOR} * w.n THEN top[3] END AS form,
         CASE WHEN -top[1] >= {spelling.FACTOR} * w.n THEN -top[1] END::BIGINT AS form_n
  FROM words w LEFT JOIN best ON w.word = best.word),
walk AS (
  SELECT word, word AS at, form AS up FROM formed
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN formed f ON walk.up = f.word)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk ON walk.word = f.word AND walk.up IS NULL
"""


def _framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR END"


def _leaf_sql(**changed: str) -> str:
    return "sha256(" + " || ".join(_framed(changed.get(c, c)) for c in manifest.LEAF) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Recursive levels of binary trees over ``leaves`` (grp, idx, n, d)."""
    return (f"{name} AS (SELECT grp, 0 AS lvl, idx, n, d FROM {leaves} UNION ALL "
            f"SELECT grp, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 2, n)")


OP13_SQL = f"""
WITH RECURSIVE told AS (
  SELECT doc_id, lang, {_leaf_sql()} AS leaf, {_leaf_sql(n_chars="(n_chars + 1)")} AS changed,
         list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS bytes FROM documents),
rows AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp, leaf, CASE WHEN {_CRC} % 7 = 0 THEN changed ELSE leaf END AS start FROM told),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n, leaf AS d FROM rows),
{_tree_sql("tree", "leaves")},
crown AS (SELECT '' AS grp, grp AS lang, row_number() OVER (ORDER BY encode(grp)) - 1 AS idx, count(*) OVER () AS n, d FROM tree WHERE n = 1),
{_tree_sql("top", "crown")},
heights AS (SELECT grp, max(lvl) AS height FROM tree GROUP BY grp),
steps AS (
  SELECT l.grp, l.idx, t.lvl, s.d AS sibling, (l.idx >> t.lvl::INT) % 2 AS slot
  FROM leaves l JOIN (SELECT DISTINCT grp, lvl FROM tree WHERE n > 1) t ON l.grp = t.grp
  LEFT JOIN tree s ON s.grp = l.grp AND s.lvl = t.lvl AND s.idx = xor(l.idx >> t.lvl::INT, 1)
  UNION ALL
  SELECT l.grp, l.idx, h.height + t.lvl, s.d, (c.idx >> t.lvl::INT) % 2
  FROM leaves l JOIN crown c ON c.lang = l.grp JOIN heights h ON h.grp = l.grp JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) t ON true
  LEFT JOIN top s ON s.lvl = t.lvl AND s.idx = xor(c.idx >> t.lvl::INT, 1)),
proofs AS (SELECT grp, idx, coalesce(string_agg(sibling, '' ORDER BY lvl), '') AS said FROM steps GROUP BY grp, idx),
folds AS (
  SELECT grp, idx, 0 AS lvl, start AS d FROM leaves
  UNION ALL
  SELECT f.grp, f.idx, f.lvl + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.d WHEN s.slot = 0 THEN f.d || s.sibling ELSE s.sibling || f.d END)
  FROM folds f JOIN steps s ON s.grp = f.grp AND s.idx = f.idx AND s.lvl = f.lvl),
ends AS (SELECT grp, idx, arg_max(d, lvl) AS folded FROM folds GROUP BY grp, idx)
SELECT l.doc_id, l.leaf, c.d AS subroot, r.d AS root, sha256(coalesce(p.said, '')) AS proof_sha256, e.folded AS folded_root, e.folded = r.d AS verified
FROM leaves l JOIN crown c ON c.lang = l.grp JOIN (SELECT d FROM top WHERE n = 1) r ON true
LEFT JOIN proofs p ON p.grp = l.grp AND p.idx = l.idx JOIN ends e ON e.grp = l.grp AND e.idx = l.idx
"""

ORACLE_SQL = {"op3_url_filter": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op5_source_mix": OP5_SQL, "op12_spelling": OP12_SQL, "op13_manifest": OP13_SQL}
