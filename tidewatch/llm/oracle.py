"""DuckDB SQL for the queries of operators that SQL can express."""

from __future__ import annotations

QUALITY_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS text FROM documents
), counted AS (
    SELECT *,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT row_no, place, array_to_string(words[place:place + 4], ' ') AS phrase
    FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS place FROM counted)
), repeated AS (
    SELECT row_no, phrase FROM windows GROUP BY row_no, phrase HAVING count(*) > 1
), covered AS (
    SELECT row_no, count(DISTINCT place + step) AS n_repeat_words
    FROM windows JOIN repeated USING (row_no, phrase), range(5) AS steps(step)
    GROUP BY row_no
), measured AS (
    SELECT row_no, doc_id, source,
        len(words) AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM counted LEFT JOIN covered USING (row_no)
), judged AS (
    SELECT *,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR n_symbols > 0.3 * n_words OR n_dup_lines > 0.1 * n_words AS any_failed
    FROM measured
), hosts AS (
    SELECT source AS host, count(*)::DOUBLE AS n, count_if(any_failed)::DOUBLE AS f
    FROM judged GROUP BY source
), sums AS (
    SELECT count(*) AS k, sum(n) AS n, sum(f) AS f, sum(n * n) AS nn, sum(f * f / n) AS ffn FROM hosts
), moments AS (
    SELECT f / n AS mean, (ffn - f * f / n) / (k - 1) AS between_hosts,
        (f - ffn) / (n - k) AS within_hosts, (n - nn / n) / (k - 1) AS usual
    FROM sums
), prior AS (
    SELECT mean, 1 / least(greatest(
        (between_hosts - within_hosts) / (between_hosts + (usual - 1) * within_hosts),
        1e-4), 0.9999) - 1 AS strength
    FROM moments
), verdicts AS (
    SELECT host, (f + mean * strength) / (n + strength) >= 0.5 AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdicts ON source IS NOT DISTINCT FROM host
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3.0, 1.0, 2.0][(place - 1) % 3 + 1]::DOUBLE AS weight,
        [0.5, 0.0, -0.5][(place - 1) % 3 + 1]::DOUBLE AS slope,
        source_size * 2.0::DOUBLE AS cap
    FROM sources
), levels AS (
    SELECT *, (
            sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        ) / sum(weight) OVER (ORDER BY cap / weight, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), goals AS (
    SELECT *, coalesce(least(cap,
        max(CASE WHEN cap > level * weight THEN level END) OVER () * weight), cap) AS target
    FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target, slope,
        coalesce(sum(size) OVER (PARTITION BY goals.source
            ORDER BY coalesce(md5(doc_id::VARCHAR), ''), doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_word
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
), readings AS (
    SELECT *,
        greatest(0, least(size, floor(target) - first_word)) AS words_1,
        greatest(0, least(size, floor(target) - first_word - source_size)) AS words_2,
        least(first_word / target, 1.0) AS share_1,
        least((first_word + source_size) / target, 1.0) AS share_2
    FROM placed
)
SELECT doc_id, size, source_size, target, (words_1 + words_2)::BIGINT AS taken,
    CASE WHEN words_1 > 0 THEN round(CASE WHEN slope = 0 THEN share_1 ELSE greatest(0, least(1,
        (sqrt((1 - slope) * (1 - slope) + 4 * slope * share_1) - (1 - slope)) / (2 * slope)))
        END, 9) END AS position,
    CASE WHEN words_2 > 0 THEN round(CASE WHEN slope = 0 THEN share_2 ELSE greatest(0, least(1,
        (sqrt((1 - slope) * (1 - slope) + 4 * slope * share_2) - (1 - slope)) / (2 * slope)))
        END, 9) END AS second_position
FROM readings
"""

MERKLE = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(entry ORDER BY i) AS entries
    FROM (SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS entry
        FROM range(256) AS numbers(i))
), sums AS (
    SELECT documents.*, xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT,
            list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
        lambda sum, byte: xor(sum >> 8, entries[(xor(sum, byte) & 255)::BIGINT + 1]))) AS crc
    FROM documents, crc_table
), leaves AS (
    SELECT coalesce('=' || lang, '') AS tree, doc_id, before_text || coalesce(strlen(text) || ':' || text, '-') AS original,
        before_text || coalesce(strlen(changed) || ':' || changed, '-') AS tampered
    FROM (SELECT *,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
            || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS before_text,
        CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            ELSE text END AS changed
        FROM sums)
), placed AS (
    SELECT tree, doc_id, sha256(original) AS leaf, sha256(tampered) AS start,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), lower_nodes AS (
    SELECT tree, 0 AS depth, place, leaf AS digest, n FROM placed
    UNION ALL
    SELECT tree, depth + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
    FROM lower_nodes WHERE n > 1 GROUP BY tree, depth, place // 8, n
), subroots AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place,
        count(*) OVER () AS n
    FROM lower_nodes WHERE n = 1
), upper_nodes AS (
    SELECT 0 AS depth, place, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT depth + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
    FROM upper_nodes WHERE n > 1 GROUP BY depth, place // 8, n
), lower_fold AS (
    SELECT tree, doc_id, 0 AS depth, place, n, start AS digest, '' AS siblings FROM placed
    UNION ALL
    SELECT f.tree, f.doc_id, f.depth + 1, f.place // 8, (f.n + 7) // 8,
        sha256(string_agg(CASE WHEN m.place = f.place THEN f.digest ELSE m.digest END, '' ORDER BY m.place)),
        f.siblings || string_agg(CASE WHEN m.place = f.place THEN '' ELSE m.digest END, '' ORDER BY m.place)
    FROM lower_fold f JOIN lower_nodes m
        ON m.tree = f.tree AND m.depth = f.depth AND m.place // 8 = f.place // 8
    WHERE f.n > 1 GROUP BY f.tree, f.doc_id, f.depth, f.place, f.n, f.digest, f.siblings
), upper_fold AS (
    SELECT f.tree, doc_id, 0 AS depth, s.place, s.n, digest, siblings
    FROM lower_fold f JOIN subroots s USING (tree) WHERE f.n = 1
    UNION ALL
    SELECT f.tree, f.doc_id, f.depth + 1, f.place // 8, (f.n + 7) // 8,
        sha256(string_agg(CASE WHEN m.place = f.place THEN f.digest ELSE m.digest END, '' ORDER BY m.place)),
        f.siblings || string_agg(CASE WHEN m.place = f.place THEN '' ELSE m.digest END, '' ORDER BY m.place)
    FROM upper_fold f JOIN upper_nodes m ON m.depth = f.depth AND m.place // 8 = f.place // 8
    WHERE f.n > 1 GROUP BY f.tree, f.doc_id, f.depth, f.place, f.n, f.digest, f.siblings
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, f.digest AS folded_root,
    f.digest = root AS verified
FROM upper_fold f JOIN placed USING (tree, doc_id) JOIN subroots USING (tree),
    (SELECT digest AS root FROM upper_nodes WHERE n = 1)
WHERE f.n = 1
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
        regexp_extract_all(coalesce(text, ''),
            '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), numbers AS (
    SELECT *, len(units) AS n,
        ('0x' || digest[1:8])::UBIGINT % (len(units) + 1) AS first,
        ('0x' || digest[9:16])::UBIGINT % (len(units) + 1) AS second,
        text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR ('0x' || digest[17:24])::UBIGINT % 100 >= 50 AS plain,
        ('0x' || digest[25:32])::UBIGINT % 100 < 80 AS spm
    FROM drawn
), parts AS (
    SELECT *, array_to_string(units[1:least(first, second)::BIGINT], '') AS prefix,
        array_to_string(units[least(first, second)::BIGINT + 1:greatest(first, second)::BIGINT], '') AS middle,
        array_to_string(units[greatest(first, second)::BIGINT + 1:], '') AS suffix
    FROM numbers
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars,
    CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
    sha256(CASE WHEN plain THEN text
        WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
    sha256(CASE WHEN plain THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op3_quality_rules": QUALITY_RULES,
    "op5_mixing": MIXING,
    "op12_merkle_manifest": MERKLE,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
