"""The queries of the operators as SQL, where SQL can express them."""

WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(CASE WHEN text IS NULL THEN 0
                     ELSE len(regexp_extract_all(text, '{WORD}')) END AS BIGINT) AS size,
           CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                || md5(coalesce(text, ''))), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
    FROM documents
), ranked AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, source_size * 2.0::DOUBLE AS most,
           sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
                ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS remaining,
           sum(weight) OVER (
                ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
    FROM ranked
), levels AS (
    SELECT source, source_size, weight, most,
           max(CASE WHEN weight * (remaining / weights_left) <= most
                    THEN remaining / weights_left END) OVER () AS level
    FROM filled
), targets AS (
    SELECT source, source_size, coalesce(least(most, weight * level), most) AS target FROM levels
), rated AS (
    SELECT doc_id, size, source_size, target, draw,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (CAST(floor(rate) AS BIGINT)
        + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS taken
FROM rated
"""

SUBSTRINGS = rf"""
WITH split AS (
    SELECT row_number() OVER () AS row, doc_id,
           coalesce(regexp_extract_all(text, '{WORD}'), []) AS words
    FROM documents
), windows AS (
    SELECT row, place, array_to_string(words[place:place + 34], ' ') AS words
    FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS place FROM split)
), repeats AS (
    SELECT words FROM windows GROUP BY words HAVING count(*) > 1
), starts AS (
    SELECT row, place FROM windows SEMI JOIN repeats USING (words)
), each AS (
    SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), marked AS (
    SELECT each.row, each.place, word,
           max(CASE WHEN starts.row IS NULL THEN 0 ELSE 1 END) OVER (
               PARTITION BY each.row ORDER BY each.place
               ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS removed
    FROM each LEFT JOIN starts ON each.row = starts.row AND each.place = starts.place
), kept AS (
    SELECT row, sum(removed) AS removed,
           string_agg(word, ' ' ORDER BY place) FILTER (removed = 0) AS text
    FROM marked GROUP BY row
)
SELECT doc_id, len(words) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row)
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang
), places AS (
    SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place
    FROM split, (SELECT unnest([1, 2, 3, 4, 5]) AS size)
), counts AS (
    SELECT lang, size, words[place:place + size - 1] AS words, count(*) AS f
    FROM places GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, size, words, f AS a, unnest(range(1, size)) AS k FROM counts WHERE size > 1
), scored AS (
    SELECT cuts.*, lefts.f AS l, rights.f AS r, n,
           CAST(1000 AS HUGEINT) * a * n // (CAST(lefts.f AS HUGEINT) * rights.f) AS score
    FROM cuts
    JOIN counts lefts ON lefts.lang = cuts.lang AND lefts.words = cuts.words[1:k]
    JOIN counts rights ON rights.lang = cuts.lang AND rights.words = cuts.words[k + 1:cuts.size]
    JOIN totals ON totals.lang = cuts.lang
), weakest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inside AS (
    SELECT DISTINCT outer_.lang, outer_.words[start:start + length - 1] AS words, outer_.f
    FROM (SELECT *, unnest(range(2, size)) AS length FROM counts WHERE size > 2) outer_,
         LATERAL (SELECT unnest(range(1, size - length + 2)) AS start)
), named AS (
    SELECT *, array_to_string(words, ' ') AS phrase FROM weakest
    WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = weakest.lang
                      AND inside.words = weakest.words AND 100 * inside.f >= 100 * weakest.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM named
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

ORACLES = {"op3_source_mix": MIX, "op9_substring_dedup": SUBSTRINGS, "op11_phrases": PHRASES}
