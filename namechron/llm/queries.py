"""The registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

#: Files of public tokenizers; the folder's place is a parameter of the operators.
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    return archive_round_trip(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), limit=4096)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), window=35).drop("kept_text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .piece_bpe import piece_digests

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical_search import build_index, search

    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=50)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_trie import numbered, prefix_trie, with_shared_heads

    return prefix_trie(*with_shared_heads(numbered(table(spark, sf_dir, "conversations"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_top_k_search, op2_byte_bpe, op3_warc, op4_line_dedup, op5_token_counts, op6_html_text, op7_decontamination, op8_near_dedup, op9_substring_dedup, op10_language_id, op11_sentencepiece, op12_lexical_search, op13_conversation_trie, pipeline)
    return {f.__name__: f for f in own}


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: Runs of characters between ASCII white space, in order.
_WORDS = r"list_filter(string_split_regex(coalesce({}, ''), '[\x09-\x0d\x20]+'), lambda w: w <> '')"


#: Unsigned CRC-32 of a decimal number's text, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split({}::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, x:
  list_reduce(range(9), lambda r, i: CASE WHEN i = 0 THEN r ELSE xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END) END, xor(c, x)), 4294967295::BIGINT), 4294967295::BIGINT)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_near_dedup": f"""
            WITH RECURSIVE w AS (
              SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS ws FROM documents
            ), s AS (
              SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh FROM w
            ), n AS (
              SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
            ), p AS (
              SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
            ), e AS (
              SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
            ), r AS (
              SELECT doc_id AS src, doc_id AS dst FROM w UNION SELECT r.src, e.y FROM r JOIN e ON r.dst = e.x
            ), c AS (
              SELECT src AS doc_id, min(dst) AS component_id FROM r GROUP BY src
            )
            SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
        "op9_substring_dedup": f"""
            WITH w AS (
              SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents
            ), s AS (
              SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, unnest(list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' ')))) AS h
              FROM w WHERE len(ws) >= 35
            ), g AS (
              SELECT DISTINCT doc_id, i + unnest(range(35)) AS j FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)
            ), v AS (
              SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w
            ), k AS (
              SELECT v.doc_id, count(*) FILTER (g.j IS NOT NULL) AS lost, string_agg(v.word, ' ' ORDER BY v.j) FILTER (g.j IS NULL) AS kept
              FROM v LEFT JOIN g ON v.doc_id = g.doc_id AND v.j = g.j GROUP BY v.doc_id
            )
            SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(lost, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
            FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
        "op1_top_k_search": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), c AS (
              SELECT vec_id, unnest(q) AS x, unnest(range(len(q))) AS i FROM v
            ), s AS (
              SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
              FROM c a JOIN c b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2
            )
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM s QUALIFY rank <= 5""",
        "op3_warc": """
            WITH d AS (
              SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
            ), b AS (
              SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(0, 160, 5), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, CAST(i // 20 * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - i % 20 AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
                min(page_id) OVER (PARTITION BY h) AS first FROM d
            )
            SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to FROM b""",
        "op4_line_dedup": f"""
            WITH l AS (
              SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_SPACE})")} AS key
              FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)
            ), k AS (
              SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
            ), m AS (
              SELECT l.*, k.key IS NOT NULL AND l.doc_id IS DISTINCT FROM k.keeper AS lost FROM l LEFT JOIN k ON l.key = k.key
            )
            SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
            FROM m GROUP BY doc_id""",
        "op12_lexical_search": r"""
            WITH d AS (
              SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
              FROM documents WHERE doc_id IS NOT NULL
            ), c AS (
              SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0
            ), q AS (
              SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM benchmark WHERE item_id IS NOT NULL
            ), t AS (
              SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
            ), w AS (
              SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c
            ), s AS (
              SELECT q.item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
              FROM q JOIN t USING (term) JOIN w USING (term), c GROUP BY ALL
            )
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 50""",
        "op13_conversation_trie": f"""
            WITH t AS (
              SELECT conv_id, md5(length(r) || ':' || r || x) AS k, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) - 1 AS i
              FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
            ), c AS (
              SELECT conv_id, conv_id - conv_id % 20 AS p, {_CRC32.format("conv_id")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
            ), u AS (
              SELECT c.conv_id, 0 AS part, t.i, k, words FROM c JOIN t ON t.conv_id = c.p AND t.i < c.h
              UNION ALL SELECT c.conv_id, 1, t.i, k, words FROM c JOIN t ON t.conv_id = c.conv_id AND t.i >= c.h
            ), s AS (
              SELECT conv_id, list(k ORDER BY part, i) AS ks, list(words ORDER BY part, i) AS ws FROM u GROUP BY conv_id
            ), a AS (
              SELECT conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM c LEFT JOIN s USING (conv_id)
            ), m AS (
              SELECT conv_id, d, md5(array_to_string(ks[1:d], ' ')) AS n, CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], ' ')) END AS up,
                CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words, d = len(ks) AS ended, list_transform(range(d + 1), lambda j: md5(array_to_string(ks[1:j], ' '))) AS above
              FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM a)
            ), g AS (
              SELECT n, d, any_value(up) AS up, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM m GROUP BY n, d
            ), k AS (
              SELECT up, count(*) AS n_children FROM g WHERE d > 0 GROUP BY up
            ), e AS (
              SELECT unnest(above) AS n, k.n_children IS NULL AS leaf, (n_convs - 1) * words AS saved FROM g LEFT JOIN k ON k.up = g.n
            ), f AS (
              SELECT n, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved FROM e GROUP BY n
            )
            SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(g.n_convs AS BIGINT) AS n_convs, CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children,
              CAST(f.n_leaves AS BIGINT) AS n_leaves, CAST(f.saved AS BIGINT) AS saved_tokens, g.ends_sha256
            FROM g JOIN f USING (n) LEFT JOIN k ON k.up = g.n LEFT JOIN g p ON p.n = g.up""",
    }
