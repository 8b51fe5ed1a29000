"""The operators on the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm.byte_bpe import bpe_round_trip
from lakestrata.llm.collocations import collocations
from lakestrata.llm.common import table
from lakestrata.llm.exact_dedup import duplicate_groups
from lakestrata.llm.fingerprints import fingerprints
from lakestrata.llm.merkle import manifest
from lakestrata.llm.near_dup import near_duplicates
from lakestrata.llm.packing import pack_documents
from lakestrata.llm.quality_cnn import score_quality
from lakestrata.llm.sharding import shard_rows
from lakestrata.llm.token_counts import token_counts
from lakestrata.llm.token_files import read_token_files, write_token_files
from lakestrata.llm.topk import top_k
from lakestrata.llm.toxicity import score_toxicity
from lakestrata.session import work_folder


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return read_token_files(spark, path)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"), hash_all=True)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_near_dup,
        op3_toxicity,
        op4_byte_bpe,
        op5_topk,
        op6_sharding,
        op7_token_files,
        op8_packing,
        op9_exact_dedup,
        op10_quality,
        op11_merkle_manifest,
        op12_collocations,
        op13_fingerprints,
    )
}

ORACLES: dict[str, str] = {
    "op5_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    # A level at a time up, then each leaf's way; crc32 goes bit by bit over the digits of the id.
    "op11_merkle_manifest": """
        WITH RECURSIVE f AS (
            SELECT doc_id, lang,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   text,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
                   list_reduce(
                       [4294967295::BIGINT] || flatten(list_transform(
                           string_split(doc_id::VARCHAR, ''),
                           lambda c: list_transform(range(8), lambda i: ((ascii(c) >> i::INTEGER) & 1)::BIGINT))),
                       lambda crc, bit: CASE WHEN xor(crc, bit) & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
                   ) AS state
            FROM documents
        ), leaves AS (
            SELECT doc_id, coalesce('1' || lang, '0') AS tree,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(state, 4294967295) % 3 = 0
                        THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS altered,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS rank
            FROM f
        ), nodes AS (
            SELECT tree, 0 AS level, rank AS place, leaf AS digest FROM leaves
            UNION ALL
            SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes)
            WHERE n > 1 GROUP BY tree, level, place // 8
        ), subroots AS (
            SELECT tree, arg_max(digest, level) AS subroot, max(level) AS height,
                   row_number() OVER (ORDER BY tree) - 1 AS rank
            FROM nodes GROUP BY tree
        ), tops AS (
            SELECT 0 AS level, rank AS place, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
            FROM (SELECT *, count(*) OVER () AS n FROM tops)
            WHERE n > 1 GROUP BY level, place // 8
        ), steps AS (
            SELECT l.doc_id, l.rank AS id_rank, l.tree, n.level,
                   string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < (l.rank >> (3 * n.level)::INTEGER)) AS before,
                   string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > (l.rank >> (3 * n.level)::INTEGER)) AS after
            FROM leaves l JOIN subroots s USING (tree)
            JOIN nodes n ON n.tree = l.tree AND n.level < s.height
             AND n.place // 8 = l.rank >> (3 * (n.level + 1))::INTEGER
            GROUP BY ALL
            UNION ALL
            SELECT l.doc_id, l.rank, l.tree, s.height + t.level,
                   string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place < (s.rank >> (3 * t.level)::INTEGER)),
                   string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place > (s.rank >> (3 * t.level)::INTEGER))
            FROM leaves l JOIN subroots s USING (tree)
            JOIN tops t ON t.level < (SELECT max(level) FROM tops)
             AND t.place // 8 = s.rank >> (3 * (t.level + 1))::INTEGER
            GROUP BY ALL
        ), folds AS (
            SELECT tree, rank, 0 AS level, coalesce(altered, leaf) AS node FROM leaves
            UNION ALL
            SELECT f.tree, f.rank, f.level + 1, sha256(coalesce(s.before, '') || f.node || coalesce(s.after, ''))
            FROM folds f JOIN steps s ON s.tree = f.tree AND s.id_rank = f.rank AND s.level = f.level
        ), proofs AS (
            SELECT tree, id_rank AS rank,
                   sha256(string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY level)) AS proof
            FROM steps GROUP BY ALL
        )
        SELECT l.doc_id, l.leaf, s.subroot, (SELECT arg_max(digest, level) FROM tops) AS root,
               coalesce(p.proof, sha256('')) AS proof_sha256, d.node AS folded_root,
               d.node = (SELECT arg_max(digest, level) FROM tops) AS verified
        FROM leaves l JOIN subroots s USING (tree)
        LEFT JOIN proofs p ON p.tree = l.tree AND p.rank = l.rank
        JOIN (SELECT tree, rank, arg_max(node, level) AS node FROM folds GROUP BY ALL) d
          ON d.tree = l.tree AND d.rank = l.rank
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, row_number() OVER () AS id,
                   list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
            FROM pieces
        ), placed AS (
            SELECT lang, id, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM worded
        ), nearby AS (
            SELECT lang, w, lead(w, 1) OVER own AS w2, lead(w, 2) OVER own AS w3, lead(w, 3) OVER own AS w4
            FROM placed WINDOW own AS (PARTITION BY id ORDER BY place)
        ), runs AS (
            SELECT lang, 1 AS m, w AS phrase FROM nearby
            UNION ALL SELECT lang, 2, concat_ws(' ', w, w2) FROM nearby WHERE w2 IS NOT NULL
            UNION ALL SELECT lang, 3, concat_ws(' ', w, w2, w3) FROM nearby WHERE w3 IS NOT NULL
            UNION ALL SELECT lang, 4, concat_ws(' ', w, w2, w3, w4) FROM nearby WHERE w4 IS NOT NULL
        ), f AS (
            SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, m, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE m > 1 AND f >= 30
        ), cuts AS (
            SELECT c.lang, c.phrase, c.m, c.a, k.k, l.f AS l, r.f AS r,
                   (2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
            FROM candidates c JOIN range(1, 4) k(k) ON k.k < c.m
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : k.k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k.k + 1 :], ' ')
        ), worst AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), covers AS (
            SELECT lang, phrase, max(a) AS longer FROM (
                SELECT c.lang, c.a, unnest(list_transform(range(1, c.m - k.k + 2),
                                           lambda i: array_to_string(c.words[i : i + k.k - 1], ' '))) AS phrase
                FROM candidates c JOIN range(2, 4) k(k) ON k.k < c.m)
            GROUP BY ALL
        ), ordered AS (
            SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM worst w LEFT JOIN covers USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
        )
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM ordered JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
