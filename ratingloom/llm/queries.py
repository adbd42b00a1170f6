"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, centroid_clustering, conversation_repair, embedding_dups, jaccard, language_id, mixing, multi_index_hashing, ngram_trie, passages, perplexity, quality_rules, sharding


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Shards of op7, and the most epochs of a source in op10.
SHARDS, REPETITION = 24, 2.0
#: op13 asks for vectors whose id this divides, and for so many neighbours.
ASKED, NEAREST = 20, 20


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict of the robust distance on every document."""
    return quality_rules.judge(_table(spark, folder, "documents"))


def op2_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every passage of 50 words or more that an earlier place holds too."""
    return passages.repeated_passages(_table(spark, folder, "documents"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    return bpe.round_trips(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and bigram log probability of every document, learned from six sevenths of them."""
    return ngram_trie.score_texts(_table(spark, folder, "documents"), language_id.fold(F.col("doc_id"), 7) == 2)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labelled ones."""
    docs = _table(spark, folder, "documents")
    held_out = language_id.fold(F.col("doc_id"), 3) == 1
    vocabulary = language_id.public_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.fit(docs.where(~held_out), vocabulary)
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op6_embedding_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector with its near duplicates' number, their component, and whether it stays."""
    return embedding_dups.near_duplicates(_table(spark, folder, "embeddings"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot; shards differ by one row at most."""
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, folder, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.into_shards(docs, SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The temperature mixture in which every source is used whole and none more than twice."""
    return mixing.mixture(_table(spark, folder, "documents"), repetition=REPETITION)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every document, and whether it is within its language's limit."""
    trusted = _table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return perplexity.classify(_table(spark, folder, "documents"), trusted)


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its shingle count and its near-duplicate component."""
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole vector's cluster after ten rounds, its distance, and the inertias."""
    return centroid_clustering.with_inertia(*centroid_clustering.cluster(_table(spark, folder, "embeddings")))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the faults that a hash of (conv_id, turn) deals out; a null is one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    dealt = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("fault")
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return dealt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """What the damage did to every conversation, the cheapest repair, and the hash of the repaired rows."""
    conversations = _table(spark, folder, "conversations")
    summary, repaired = conversation_repair.repair(damaged(conversations))
    hashes = conversation_repair.digests(repaired)
    found = conversations.select("conv_id").distinct()
    found = found.join(summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    found = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    numbers = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products found for every twentieth vector."""
    vectors = _table(spark, folder, "embeddings")
    return multi_index_hashing.nearest(vectors, F.col("vec_id") % ASKED == 0, NEAREST)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_passages": op2_passages,
    "op3_bpe": op3_bpe,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_language_id": op5_language_id,
    "op6_embedding_dups": op6_embedding_dups,
    "op7_sharding": op7_sharding,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_jaccard": op9_jaccard,
    "op10_mixing": op10_mixing,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}



def _centroid_rounds(rounds: int) -> str:
    """Rounds of assignment and exact floors of means, one CTE each."""
    parts = []
    for n in range(rounds + 1):
        parts.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, min(d * 8 + k) AS best
            FROM (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM cells JOIN c{n} USING (i) GROUP BY r, k) GROUP BY r)""")
        if n < rounds:
            parts.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT c{n}.k, c{n}.i, coalesce((s - ((s % n) + n) % n) // n, c) AS c
            FROM c{n} LEFT JOIN (
                SELECT best % 8 AS k, i, sum(x)::BIGINT AS s, count(*) AS n FROM cells JOIN a{n} USING (r) GROUP BY best % 8, i
            ) m ON m.k = c{n}.k AND m.i = c{n}.i)""")
    return ",".join(parts)


def _edit(state: str, weight: str, letter: str, line: str) -> str:
    """A cheapest end (ten digits of cost, audit, chr(1), repaired lines) with one more edit before it."""
    rest = f"substr({state}, 11)"
    return (
        f"lpad(CAST(CAST(substr({state}, 1, 10) AS BIGINT) + {weight} AS VARCHAR), 10, '0') || '{letter}' "
        f"|| split_part({rest}, chr(1), 1) || chr(1) || {line} || substr({rest}, instr({rest}, chr(1)) + 1)"
    )


def _with_inserts(p: str) -> str:
    """Cheapest ends of every state, with rows inserted before them: an answer after u, a question after any other."""
    answer, question = _edit("f3", "3", "I", "chr(10) || 'assistant:'"), _edit("f2", "3", "I", "chr(10) || 'user:'")
    ahead = _edit("g2", "3", "I", "chr(10) || 'user:'")
    return f"""
        SELECT {p}, least(f0, {ahead}) AS g0, least(f1, {ahead}) AS g1, g2, g3
        FROM (SELECT *, least(f2, {answer}) AS g2, least(f3, {question}) AS g3 FROM ends)"""


def _row_edits() -> str:
    """Cheapest ends of every state before a row: deleted, kept, or with another role."""
    kept = "chr(10) || role || ':' || text"
    give = {"g2": _edit("g2", "3 + extra", "R", "chr(10) || 'user:' || text"), "g3": _edit("g3", "3 + extra", "R", "chr(10) || 'assistant:' || text")}
    keep = {g: _edit(g, "extra", "K", kept) for g in ("g1", "g2", "g3")}
    follows = {0: "g2", 1: "g2", 2: "g3", 3: "g2"}
    columns = []
    for p, g in follows.items():
        own = {"g2": "u", "g3": "a"}[g]
        system = f"WHEN initial = 's' THEN {keep['g1']} " if p == 0 else ""
        columns.append(f"""least({_edit(f"g{p}", "4", "D", "''")},
            CASE WHEN NOT goes THEN least(CASE WHEN initial = '{own}' THEN {keep[g]} {system}END, {give[g]}) END) AS f{p}""")
    return ",\n        ".join(columns)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op12_conversation_repair": f"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        dealt AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
                       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
            FROM conversations, crc_table),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM dealt WHERE fault <> 0),
        numbered AS (
            SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid, left(role, 1) AS initial,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words
            FROM damaged),
        judged AS (
            SELECT *, CASE WHEN words = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS wrong,
                   CASE WHEN n > 1 AND lag(initial) OVER (PARTITION BY cid ORDER BY n) || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS unlawful
            FROM numbered),
        edited AS (SELECT cid, n, role, text, initial, wrong IN ('blank', 'duplicate') AS goes, CASE WHEN wrong = 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
        states(cid, i, g0, g1, g2, g3) AS (
            WITH ends AS (SELECT cid, max(n) AS i, repeat('0', 10) || chr(1) AS f0, CAST(NULL AS VARCHAR) AS f1, CAST(NULL AS VARCHAR) AS f2, repeat('0', 10) || chr(1) AS f3 FROM edited GROUP BY cid)
            {_with_inserts("cid, i")}
            UNION ALL
            (WITH ends AS (
                SELECT states.cid, states.i - 1 AS i,
        {_row_edits()}
                FROM states JOIN edited ON edited.cid = states.cid AND edited.n = states.i)
            {_with_inserts("cid, i")})),
        cheapest AS (
            SELECT cid, CAST(substr(g0, 1, 10) AS BIGINT) AS cost, split_part(substr(g0, 11), chr(1), 1) AS audit,
                   sha256(substr(g0, 10 + instr(substr(g0, 11), chr(1)) + 2)) AS repaired_sha256
            FROM states WHERE i = 0),
        counted AS (
            SELECT cid, any_value(conv_id) AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (wrong = 'blank') AS blank, count(*) FILTER (wrong = 'duplicate') AS duplicate,
                   count(*) FILTER (wrong = 'truncated') AS truncated, CAST(sum(unlawful) AS BIGINT) AS illegal
            FROM judged GROUP BY cid)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN (SELECT * FROM counted JOIN cheapest USING (cid)) f ON f.conv IS NOT DISTINCT FROM o.conv_id""",
    "op11_centroid_clustering": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cells AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
        c0 AS MATERIALIZED (
            SELECT k, unnest(v) AS c, generate_subscripts(v, 1) AS i
            FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS k FROM kept) WHERE k < 8),
        {_centroid_rounds(centroid_clustering.ROUNDS)},
        digests AS (
            SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{centroid_clustering.ROUNDS} GROUP BY k),
        assigned AS (SELECT vec_id, best % 8 AS k, best // 8 AS distance FROM kept JOIN a{centroid_clustering.ROUNDS} USING (r))
        SELECT vec_id, k::INTEGER AS cluster, distance,
               (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM assigned JOIN digests USING (k)""",
    "op9_jaccard": f"""
        WITH RECURSIVE split AS (
            SELECT doc_id,
                   regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id,
                   CASE WHEN len(ws) >= 3 THEN ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]
                        ELSE array_to_string(ws, ' ') END AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM split WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
            FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT u, v FROM common JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id
            WHERE 100 * c >= 90 * (x.n + y.n - c)),
        reach AS (
            SELECT doc_id AS node, doc_id AS other FROM documents
            UNION
            SELECT r.node, e.v FROM reach r
            JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) e ON r.other = e.u)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
        FROM documents d
        JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
        LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    "op6_embedding_dups": """
        WITH RECURSIVE unit AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
            WHERE list_dot_product(a.e, b.e) >= 0.95 * sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e))
              AND list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0),
        counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
        reach AS (
            SELECT vec_id AS node, vec_id AS other FROM unit
            UNION
            SELECT r.node, l.v FROM reach r JOIN links l ON r.other = l.u)
        SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, r.component_id = e.vec_id AS kept
        FROM embeddings e
        JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = e.vec_id
        LEFT JOIN counts c ON c.u = e.vec_id""",
}
