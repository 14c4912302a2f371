"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from wardstar.llm import (
    bpe,
    decontamination,
    language_model,
    minhash,
    packing,
    phrases,
    prefix_trie,
    sharding,
    substrings,
    syncmers,
    token_files,
    toxicity,
    warc,
)

QUERIES = {
    "op1_sharding": sharding.query,
    "op2_near_dedup": minhash.query,
    "op3_token_files": token_files.query,
    "op4_language_model": language_model.query,
    "op5_packing": packing.query,
    "op6_fingerprints": syncmers.query,
    "op7_toxicity": toxicity.query,
    "op8_substring_dedup": substrings.query,
    "op9_warc": warc.query,
    "op10_decontamination": decontamination.query,
    "op11_collocations": phrases.query,
    "op12_bpe": bpe.query,
    "op13_prefix_trie": prefix_trie.query,
}
ORACLES: dict[str, str] = {
    # Twenty bytes are 32 base32 digits of five bits.
    "op9_warc": """
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS payload, list_aggregate(
                [lpad(bin(('0x' || d)::INT), 4, '0')
                    FOR d IN string_split(sha1(coalesce(html, '')), '')],
                'string_agg', '') AS bits
            FROM pages
        ), largest AS (
            SELECT payload, max(page_id) AS page_id FROM hashed GROUP BY payload
        )
        SELECT h.page_id, strlen(h.payload)::BIGINT AS payload_bytes, list_aggregate(
                [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ('0b' || substr(bits, 1 + 5 * k, 5))::INT, 1) FOR k IN range(32)],
                'string_agg', '') AS payload_digest,
            CASE WHEN h.page_id = l.page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN h.page_id <> l.page_id THEN l.page_id END AS refers_to
        FROM hashed h JOIN largest l ON h.payload = l.payload
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), counts AS (
            SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
            FROM (
                SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM lists, (SELECT unnest([1, 2, 3, 4]) AS size)
            ) GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
        ), candidates AS (
            SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 30
        ), cuts AS (
            SELECT c.lang, c.size, c.phrase, c.f, k, l.f AS l, r.f AS r,
                (2000000::HUGEINT * c.f // (l.f + r.f))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
            JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
            JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
        ), lowest AS (
            SELECT * FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS longer
            FROM (
                SELECT *, unnest(range(i + 1, size + 1)) AS j
                FROM (SELECT *, unnest(range(1, size)) AS i FROM candidates)
            ) WHERE j - i + 1 < size GROUP BY ALL
        )
        SELECT lang, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, c.f DESC, c.phrase) AS rank,
            c.phrase, c.f AS a, l, r, n, score
        FROM lowest c LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
        WHERE longer IS NULL OR 100 * longer < 80 * c.f
        QUALIFY rank <= 2000
    """,
    # The remainder comes from the CRC-32 of the number's digits, bit by bit.
    "op13_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, strlen(coalesce(text, '')) AS bytes, length(coalesce(text, '')) AS chars,
                sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
                    || coalesce(text, '')) AS digest, turn
            FROM conversations WHERE conv_id IS NOT NULL
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS i
            FROM turns
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS family, xor(4294967295, list_reduce(
                flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
                    FOR c IN string_split(conv_id::VARCHAR, '')]),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x::BIGINT)
                    WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
                4294967295::BIGINT)) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), parts AS (
            SELECT c.conv_id, n.i, n.digest, n.chars FROM convs c JOIN numbered n
                ON n.conv_id = c.family AND n.i < c.h
            UNION ALL
            SELECT c.conv_id, n.i, n.digest, n.chars FROM convs c JOIN numbered n
                ON n.conv_id = c.conv_id AND n.i >= c.h
        ), listed AS (
            SELECT conv_id, list(digest ORDER BY i) AS digests, list(chars ORDER BY i) AS chars
            FROM parts GROUP BY conv_id
        ), prefixes AS (
            SELECT conv_id, d, array_to_string(digests[1:d], ' ') AS node, chars[d] AS chars,
                array_to_string(digests[1:d - 1], ' ') AS parent, d = len(digests) AS ends
            FROM (SELECT *, unnest(range(1, len(digests) + 1)) AS d FROM listed)
            UNION ALL
            SELECT c.conv_id, 0, '', 0, NULL, l.conv_id IS NULL
            FROM convs c LEFT JOIN listed l ON l.conv_id = c.conv_id
        ), nodes AS (
            SELECT d, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * min(chars) AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                    FILTER (ends), '')) AS ends_sha256
            FROM prefixes GROUP BY d, node
        ), counted AS (
            SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.parent = n.node) AS n_children
            FROM nodes n
        ), below AS (
            SELECT p.d, p.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum(c.saved) AS saved_tokens
            FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.d <= c.d GROUP BY p.d, p.node
        )
        SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
            b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM counted n JOIN below b ON b.d = n.d AND b.node = n.node
            LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.parent
    """,
}
