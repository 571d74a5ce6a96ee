"""The operators as queries over the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitebooks.llm import decontaminate, dialogue, infill, jaccard, language, neighbours, packing, pages, repeats, secrets, sharding, simhash, tokens
from sitebooks.llm.common import ready

TOKEN_LIMIT, SHARDS, ASKED, NEAREST = 4096, 40, 50, 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    found = tokens.counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents.where(~language.held_out(F.col("doc_id"))))
    found = language.predict(documents, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    found = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), [1.0] * SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extracted(table(spark, sf_dir, "pages"))


def op6_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.with_checksums(packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents with smaller ids have."""
    found = repeats.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    )
    return decontaminate.verdict(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % ASKED == 0), NEAREST)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for infilling."""
    return infill.digest(infill.transformed(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.digest(dialogue.repaired(conversations), conversations)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of documents with similar sets of word triples, for every document."""
    return jaccard.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_language_id,
        op3_simhash,
        op4_rendezvous_shards,
        op5_main_text,
        op6_cost_packing,
        op7_substring_dedup,
        op8_secret_scan,
        op9_decontamination,
        op10_nearest,
        op11_fill_in_middle,
        op12_dialogue_repair,
        op13_jaccard_join,
    )
}

SHARDS_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
           lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT range::BIGINT AS i FROM range(256))),
d AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
sized AS (
  SELECT doc_id, k, strlen(body)::BIGINT + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(body), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM d, crc),
claims AS (
  SELECT *, list_transform(range({SHARDS} + 1), lambda s: {{
      'score': 1.0::DOUBLE / -ln((('0x' || substr(md5(k || ':' || s::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
                                 / 4503599627370496.0::DOUBLE),
      'o': -s}}) AS c
  FROM sized),
won AS (
  SELECT doc_id, size, text_crc32, (-(list_max(c[1:{SHARDS}])).o)::INTEGER AS shard, (-(list_max(c)).o)::INTEGER AS grown_shard,
         ('0x' || substr(md5(k || ':' || size::VARCHAR || ':' || text_crc32::VARCHAR), 1, 8))::BIGINT % {sharding.PIECES} AS piece
  FROM claims)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY piece, doc_id, size, text_crc32) - 1 AS slot
FROM won"""

REPEATS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w WHERE len(words) >= 13)),
gone AS (
  SELECT doc_id, list(p) AS ps FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS low FROM starts)
  WHERE low < doc_id GROUP BY doc_id),
covered AS (
  SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 13)))) AS c FROM gone)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(c), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
         CASE WHEN c IS NULL THEN words
              ELSE list_filter(words, lambda x, i: NOT list_contains(c, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN covered USING (doc_id)"""

CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item AS (
  SELECT DISTINCT item_id, n, array_to_string(words[p:p + n - 1], ' ') AS k
  FROM (SELECT item_id, words, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p
        FROM b WHERE len(words) > 0)),
doc AS (
  SELECT doc_id, p, n, array_to_string(words[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM item) WHERE len(words) >= n)),
hit AS (SELECT doc_id, p, doc.n, item_id FROM doc JOIN item ON doc.n = item.n AND doc.k = item.k),
found AS (
  SELECT doc_id, len(list_distinct(flatten(list(range(p, p + n)))))::BIGINT AS n_hit,
         list_sort(list(DISTINCT item_id::VARCHAR)) AS items
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN found USING (doc_id)"""

INFILL_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90
              THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
cut AS (
  SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, abs(a - b)) AS m, substr(t, greatest(a, b) + 1) AS s
  FROM drawn),
made AS (
  SELECT *, CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END AS output
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form
         WHEN 'psm' THEN substr(split_part(output, '<S>', 1), 4) || split_part(output, '<M>', 2)
                         || split_part(split_part(output, '<S>', 2), '<M>', 1)
         WHEN 'spm' THEN split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2)
                         || substr(split_part(output, '<P>', 1), 4)
         ELSE output END) AS restored_sha256
FROM made"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS grams
  FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS g FROM s),
linked AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common
                    FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL)
  WHERE 100 * common >= 90 * (nx + ny - common)),
pairs AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach AS (
  SELECT DISTINCT x AS doc_id, x AS other FROM pairs
  UNION
  SELECT reach.doc_id, pairs.y FROM reach JOIN pairs ON reach.other = pairs.x)
SELECT s.doc_id, len(grams)::BIGINT AS n_shingles, coalesce(low, s.doc_id) AS component_id
FROM s LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON s.doc_id = r.doc_id"""


def _repair_sql() -> str:
    """Edits of conversations from their last row on: per state the cheapest rest, of equally cheap ones the least word.

    States: 0 nothing yet, 1 behind a system row, 2 a user row, 3 an assistant row.
    """
    after = (2, 2, 3, 2)
    best = lambda state: f"b.best[{state + 1}]"
    item = lambda c, w, lines: f"{{'c': {c}, 'w': {w}, 'l': {lines}}}"

    def edited(state: int) -> str:
        to, role = after[state], "'user:'" if after[state] == 2 else "'assistant:'"
        delete = item(f"2 + {best(state)}.c", f"'D' || {best(state)}.w", f"{best(state)}.l")
        rerole = item(f"1 + cut + {best(to)}.c", f"'R' || {best(to)}.w", f"list_prepend({role} || text, {best(to)}.l)")
        keep = {0: "initial IN ('s', 'u')", 1: "initial = 'u'", 2: "initial = 'a'", 3: "initial = 'u'"}[state]
        kept = lambda t: item(f"cut + {best(t)}.c", f"'K' || {best(t)}.w", f"list_prepend(role || ':' || text, {best(t)}.l)")
        goes = f"CASE initial WHEN 's' THEN {kept(1)} WHEN 'u' THEN {kept(2)} ELSE {kept(3)} END"
        return f"CASE WHEN gone THEN {delete} WHEN {keep} THEN least({delete}, {rerole}, {goes}) ELSE least({delete}, {rerole}) END"

    def inserted(state: int) -> str:
        ways, to, lines = [f"e[{state + 1}]"], state, []
        for k in range(1, 4):
            to = after[to]
            lines.append("'user:'" if to == 2 else "'assistant:'")
            ways.append(item(f"{5 * k} + e[{to + 1}].c", f"'{'I' * k}' || e[{to + 1}].w", f"list_concat([{', '.join(lines)}], e[{to + 1}].l)"))
        return f"least({', '.join(ways)})"

    ends = [item("0::BIGINT", "''", "[]::VARCHAR[]"), item("10::BIGINT", "'II'", "['user:', 'assistant:']"),
            item("5::BIGINT", "'I'", "['assistant:']"), item("0::BIGINT", "''", "[]::VARCHAR[]")]
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
           lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT range::BIGINT AS i FROM range(256))),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(
               hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295::BIGINT) % 20 AS luck
  FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role,
         CASE luck WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE luck = 3) WHERE luck <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice,
         regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) NOT IN ('.', '!', '?') AS short
  FROM o),
r AS (SELECT *, blank OR twice AS gone, CASE WHEN short AND NOT blank AND NOT twice THEN 5 ELSE 0 END AS cut FROM f),
n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE twice AND NOT blank) AS duplicate,
         count(*) FILTER (WHERE cut > 0) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
b AS (
  SELECT conv_id, n + 1 AS i, [{', '.join(ends)}] AS best FROM n
  UNION ALL
  SELECT conv_id, i, [{', '.join(inserted(s) for s in range(4))}] FROM (
    SELECT b.conv_id, b.i - 1 AS i, [{', '.join(edited(s) for s in range(4))}] AS e
    FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best[1].c, 0) AS cost,
       coalesce(best[1].w, '') AS audit, sha256(coalesce(array_to_string(best[1].l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = 1"""


ORACLE: dict[str, str] = {
    "op4_rendezvous_shards": SHARDS_SQL,
    "op7_substring_dedup": REPEATS_SQL,
    "op9_decontamination": CONTAMINATION_SQL,
    "op11_fill_in_middle": INFILL_SQL,
    "op12_dialogue_repair": _repair_sql(),
    "op13_jaccard_join": JACCARD_SQL,
}
