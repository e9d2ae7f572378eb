"""The same results as some of the operators' queries, in DuckDB SQL."""

from __future__ import annotations

# White space that parts words, and the signs that part words of features.
_WORD = r"[^\x20\x09-\x0D]+"
_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The registers of a CRC-32 behind each byte value; of_crc reads them from the table crc_table.
_CRC_TABLE = """
    crc_table AS (
        SELECT list(register ORDER BY byte) AS registers FROM (
            SELECT byte, list_reduce(
                list_prepend(byte, range(8)),
                lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END
            ) AS register
            FROM range(256) bytes(byte)
        )
    )
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes; ``registers`` must be in scope."""
    size = f"octet_length(encode({text}))"
    byte = f"CAST('0x' || hex(encode({text}))[2 * i - 1:2 * i] AS BIGINT)"
    all_bytes = f"list_transform(range(1, {size} + 1), lambda i: {byte})"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {all_bytes}), "
        "lambda r, b: xor(r >> 8, registers[(xor(r, b) & 255) + 1])), 4294967295)"
    )


PREFIX_TRIE = f"""
    WITH {_CRC_TABLE}, turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), own AS (
        SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY
                   turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS said
        FROM turns GROUP BY conv_id
    ), shared AS (
        SELECT conv_id, said, conv_id - conv_id % 20 AS family, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h
        FROM own, crc_table
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(f.said[1:c.h], []), c.said[c.h + 1:]) AS said
        FROM shared c LEFT JOIN own f ON f.conv_id = c.family
    ), prefixes AS (
        SELECT conv_id, d, said[1:d] AS prefix, d = len(said) AS whole
        FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256,
               CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '{_WORD}')) END AS words
        FROM prefixes GROUP BY prefix, d
    ), children AS (
        SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
    ), counted AS (
        SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)
    ), below AS (
        SELECT prefix[1:k] AS prefix, n_children, (n_convs - 1) * words AS saved
        FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted)
    ), subtrees AS (
        SELECT prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
        FROM below GROUP BY prefix
    )
    SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, CAST(c.n_children AS BIGINT) AS n_children,
           s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
    FROM counted c JOIN subtrees s USING (prefix)
    LEFT JOIN nodes p ON c.d > 0 AND p.prefix = c.prefix[1:c.d - 1]
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RESAMPLING = f"""
    WITH {_CRC_TABLE}, corpus AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_FEATURE}') AS words FROM documents
    ), target AS (
        SELECT regexp_extract_all({_LOWERED}, '{_FEATURE}') AS words FROM benchmark
    ), said AS (
        SELECT r, unnest(words) AS word FROM corpus
    ), wanted AS (
        SELECT unnest(words) AS word FROM target
    ), buckets AS (
        SELECT word, {_crc32("word")} % 10000 AS bucket
        FROM (SELECT word FROM said UNION SELECT word FROM wanted), crc_table
    ), s AS (
        SELECT bucket, count(*) AS s FROM said JOIN buckets USING (word) GROUP BY bucket
    ), t AS (
        SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket
    ), sums AS (
        SELECT (SELECT count(*) FROM said) AS all_s, (SELECT count(*) FROM wanted) AS all_t
    ), gains AS (
        SELECT bucket, floor(1000 * ln(
                   CAST(coalesce(t, 0) + 1 AS DOUBLE) * (all_s + 10000) / (CAST(s + 1 AS DOUBLE) * (all_t + 10000)))) AS gain
        FROM s LEFT JOIN t USING (bucket), sums
    ), weights AS (
        SELECT r, floor(sum(gain) / count(*)) AS weight FROM said JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r
    ), scored AS (
        SELECT r, doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
               CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
        FROM corpus LEFT JOIN weights USING (r)
    ), noisy AS (
        SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
    ), ranked AS (
        SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS able
        FROM noisy WHERE n_features >= 20
    )
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, rank
    FROM noisy LEFT JOIN (SELECT r, rank FROM ranked WHERE rank <= able * 10 // 100) USING (r)
"""

PAGE_RECORDS = """
    WITH payloads AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (
        SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
    FROM payloads LEFT JOIN firsts USING (payload_digest)
"""

# The rules of lines. Letters that are capitals without being of the class Lu are named; \u0131 for an i is not.
_ITEMS, _ITEM_WORDS = "[|•·»›]", "'>', '—', '–', '-', '*', '/'"
_CAPITAL = (
    r"[\p{Lu}\x{2160}-\x{216F}\x{24B6}-\x{24CF}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}]"
)
_MARK, _SYMBOL = "[.,;:!?…。！？、]", "[#*$%&|<>]"


def _found(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def line_quality(boilerplate: str, most_lost: float) -> str:
    """The measures and verdicts of ``line_rules.line_quality``, by its phrases of page furniture and its share."""
    return f"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    ), spoken AS (
        SELECT r, unnest(regexp_extract_all(text, '{_WORD}')) AS word,
               generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) AS place
        FROM texts
    ), windows AS (
        SELECT r, place, word || ' ' || lead(word) OVER said || ' ' || lead(word, 2) OVER said AS three
        FROM spoken WINDOW said AS (PARTITION BY r ORDER BY place)
    ), repeated AS (
        SELECT r, unnest([place, place + 1, place + 2]) AS place
        FROM (SELECT *, count(*) OVER (PARTITION BY r, three) AS times FROM windows WHERE three IS NOT NULL)
        WHERE times > 1
    ), repeats AS (
        SELECT r, count(DISTINCT place) AS n_repeat_words FROM repeated GROUP BY r
    ), counted AS (
        SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM spoken GROUP BY r
    ), split AS (
        SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number
        FROM texts
    ), worded AS (
        SELECT *, regexp_extract_all(line, '{_WORD}') AS words FROM split
    ), parted AS (
        SELECT *, len(words) AS n, regexp_matches(line, '{_MARK}') AS marked,
               list_filter(words, lambda w: w NOT IN ({_ITEM_WORDS})) AS others,
               coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS chars
        FROM worded
    ), judged AS (
        SELECT *, {_found("line", _ITEMS)} + n - len(others) AS parts,
               {_found(f"regexp_replace(array_to_string(others, ' '), '{_ITEMS}', ' ', 'g')", _WORD)} AS items,
               {_found("line", r"\p{L}")} AS letters, {_found("line", _CAPITAL)} AS capitals,
               n > 3 OR marked OR length(line) >= 200 AS breaks
        FROM parted WHERE n > 0
    ), runs AS (
        SELECT *, sum(CAST(breaks AS INT)) OVER (PARTITION BY r ORDER BY number) AS run FROM judged
    ), failing AS (
        SELECT *,
            (NOT breaks AND count(*) FILTER (WHERE NOT breaks) OVER (PARTITION BY r, run) >= 4)
            OR (parts >= 3 AND 5 * parts >= items)
            OR (n >= 3 AND 2 * len(list_filter(words, lambda w: regexp_matches(w, '{_SYMBOL}'))) > n)
            OR ((n >= 8 OR (n >= 5 AND contains(line, '!'))) AND letters >= 20 AND 5 * capitals > 4 * letters)
            OR (n >= 20 AND NOT marked)
            OR (n <= 25 AND regexp_matches(line, '(?i){boilerplate}')) AS fails
        FROM runs
    ), lines AS (
        SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_bad_lines,
               coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost_chars
        FROM failing GROUP BY r
    ), measured AS (
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               {_found("text", _SYMBOL)} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_bad_lines, 0) AS n_bad_lines,
               coalesce(CAST(lost_chars AS DOUBLE) / CAST(word_chars AS DOUBLE), 0) AS lost
        FROM texts LEFT JOIN counted USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
    )
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_bad_lines AS BIGINT) AS n_bad_lines, lost,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND lost <= {most_lost} AS kept
    FROM measured
"""


def _ascii_cases(words: str) -> str:
    """A pattern for letters of A-Z in either case; the engine's own folding also takes signs beyond ASCII."""
    return "".join(f"[{sign.upper()}{sign}]" if sign.isascii() and sign.isalpha() else sign for sign in words)


# Fixed values of the base kinds, as in secret_scan.
_ASSIGNED = (
    f"(?:{_ascii_cases('password|passwd|secret|token|api_?key')})"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_KNOWN_AS = (
    f"{_ascii_cases('example|sample|dummy|placeholder|changeme|change')}[_-]{_ascii_cases('me')}|{_ascii_cases('your')}[_-]"
    f"|{_ascii_cases('redacted|xxxx|abcdefghij|qwertyuiop')}|0123456789|1234567890"
    "|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    rf"|\A(?:{_ascii_cases('sha')}(?:1|256|384|512)|{_ascii_cases('md')}5)[-=]"
)
_KNOWN_AFTER = (
    rf"(?:;{_ascii_cases('base')}64,|\b(?:{_ascii_cases('sha')}-?(?:1|256|384|512)|{_ascii_cases('md')}5|{_ascii_cases('crc')}32"
    rf"|{_ascii_cases('etag|commit|revision|digest|checksum|integrity')})\b\W{{0,3}})\z"
)


def _placed(kind: str, rank: int, pattern: str, value: str, least: int) -> str:
    """Matches of a pattern without a look to its sides, placed by the lengths of gaps and matches up to each."""
    return f"""
        SELECT r, '{kind}' AS kind, {rank} AS rank, ends - length(match) AS start, ends, match
        FROM (
            SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY r ORDER BY k) AS ends FROM (
                SELECT r, unnest(matches) AS match, unnest(vals) AS val, unnest(gaps[1:len(matches)]) AS gap,
                       generate_subscripts(matches, 1) AS k
                FROM (
                    SELECT r, regexp_extract_all(text, '{pattern}') AS matches, regexp_extract_all(text, '{pattern}', {value}) AS vals,
                           string_split_regex(text, '{pattern}') AS gaps
                    FROM texts
                )
            )
        ) WHERE length(val) >= {least}
    """


def _sum_of_terms(window: str) -> str:
    """The sum of n * log2(n) over the counts n of a string's characters."""
    signs = f"string_split({window}, '')"
    return f"list_sum(list_transform(map_values(list_histogram({signs})), lambda n: n * log2(n)))"


SECRETS = f"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    ), base AS (
        {_placed("assign", 0, _ASSIGNED, "1", 6)}
        UNION ALL {_placed("access", 1, "AKIA[A-Z0-9]+", "0", 20)}
        UNION ALL {_placed("hex", 2, "[0-9a-f]+", "0", 24)}
    ), candidates AS (
        {_placed("entropy", 3, "[A-Za-z0-9+/_=-]+", "0", 20)}
    ), classes AS (
        SELECT *,
            CASE WHEN regexp_full_match(match, '[0-9a-f]+|[0-9A-F]+') THEN 24 ELSE 20 END AS size,
            CASE WHEN regexp_full_match(match, '[0-9a-f]+|[0-9A-F]+') THEN 2.9::DOUBLE
                 WHEN regexp_full_match(match, '[A-Z0-9]+|[a-z0-9]+') THEN 3.5::DOUBLE ELSE 3.75::DOUBLE END AS least
        FROM candidates
    ), unknown AS (
        SELECT classes.* FROM classes JOIN texts USING (r)
        WHERE NOT regexp_matches(match, '{_KNOWN_AS}')
          AND NOT regexp_matches(text[greatest(start - 23, 1):start], '{_KNOWN_AFTER}')
    ), views AS (
        SELECT *, substr(match, place, size) AS seen
        FROM (SELECT *, unnest(range(1, length(match) - size + 2)) AS place FROM unknown)
    ), hot AS (
        SELECT r, start AS candidate, start + place - 1 AS start, size FROM views
        WHERE len(regexp_extract_all(seen, '[0-9]')) >= 2 AND len(regexp_extract_all(seen, '[A-Za-z]')) >= 4
          AND log2(size) - {_sum_of_terms("seen")} / size >= least
    ), parted AS (
        SELECT *, coalesce(lag(start) OVER one + size < start, true) AS new FROM hot WINDOW one AS (PARTITION BY r, candidate ORDER BY start)
    ), ranges AS (
        SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY r, candidate ORDER BY start) AS part FROM parted
    ), added AS (
        SELECT r, 'entropy' AS kind, 3 AS rank, min(start) AS start, max(start + size) AS ends FROM ranges GROUP BY r, candidate, part
    ), spans AS (
        SELECT r, kind, rank, start, ends FROM base
        UNION ALL
        SELECT * FROM added
        WHERE NOT EXISTS (FROM base WHERE base.r = added.r AND base.start < added.ends AND base.ends > added.start)
    ), written AS (
        SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
               count(*) FILTER (WHERE rank = 2) AS n_hex, count(*) FILTER (WHERE rank = 3) AS n_entropy,
               string_agg(kind || ':' || start || ':' || ends, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS bases,
               string_agg(kind || ':' || start || ':' || ends, ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY r
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(bases, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN written USING (r)
"""
