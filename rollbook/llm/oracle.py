"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from rollbook.llm.license import template_rows

#: The text of both turns of conversation -1.
PROBE = "</s>[INST] ok [/INST]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in template_rows())
_WORDS = (
    r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), "
    "lambda x: x <> '')"
)
_RUNS = """list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"""

#: CRC-32 of a text's UTF-8 bytes: the byte table from its rule, then one step a byte.
_CRC_TABLE = """bits(i, k, v) AS (
            SELECT i::UINTEGER, 0, i::UINTEGER FROM range(256) AS r(i)
            UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UINTEGER) ELSE v >> 1 END FROM bits WHERE k < 8
        ), crc_table AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8)"""
_NIBBLE = "(instr('0123456789ABCDEF', substr(x, {}, 1)) - 1)"


def _crc(text: str) -> str:
    """For a query with ``crc_table`` among its tables."""
    byte = f"({_NIBBLE.format('2 * i + 1')} * 16 + {_NIBBLE.format('2 * i + 2')})::UINTEGER"
    octets = f"list_transform([hex(encode({text}))], lambda x: list_transform(range(len(x) // 2), lambda i: {byte}))[1]"
    start = "[4294967295::UINTEGER]"
    return f"xor(4294967295::UINTEGER, list_reduce({start} || {octets}, lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))"


ORACLE = {
    "op2_main_text": r"""
        WITH a AS (
            SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
        ), b AS (
            SELECT page_id, url, list_transform(
                string_split_regex(replace(body, '<br>', ' '), '</?(p|h1)>'),
                lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
                    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))
            ) AS blocks
            FROM a
        ), c AS (
            SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM c
    """,
    "op4_license_scan": f"""
        WITH looked_for AS (
            SELECT template_id, {_WORDS} AS w FROM (VALUES {_TEMPLATES}) AS v(template_id, text)
        ), texts AS (
            SELECT row_number() OVER () AS line, doc_id, {_WORDS} AS w FROM documents
        ), t AS (
            SELECT template_id, unnest(s) AS shingle, len(s) AS shingles
            FROM (SELECT template_id, {_RUNS} AS s FROM looked_for WHERE len(w) >= 5)
        ), d AS (
            SELECT line, doc_id, unnest({_RUNS}) AS shingle FROM texts
        )
        SELECT any_value(doc_id) AS doc_id, template_id, count(*)::INT AS matched, any_value(shingles)::INT AS shingles
        FROM d JOIN t USING (shingle) GROUP BY line, template_id HAVING count(*) >= 0.8 * any_value(shingles)
        UNION ALL
        SELECT doc_id, template_id, 1, 1
        FROM (SELECT doc_id, len(w) AS n, array_to_string(w, ' ') AS doc FROM texts)
        JOIN (SELECT template_id, array_to_string(w, ' ') AS brief FROM looked_for WHERE len(w) BETWEEN 1 AND 4)
          ON CASE WHEN n >= 5 THEN contains(' ' || doc || ' ', ' ' || brief || ' ') ELSE doc = brief END
    """,
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT *, first_value(doc_id) OVER (
                       PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked
    """,
    "op7_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                ELSE w END) AS s FROM w
        ), e AS (
            SELECT doc_id, unnest(s) AS shingle, len(s) AS n FROM s
        ), links AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y USING (shingle) WHERE x.doc_id <> y.doc_id
            GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM s
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), root AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN root USING (doc_id)
    """,
    "op9_chat_format": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
        ), turns AS (
            SELECT *, CASE
                WHEN contains(text, '<\|') OR contains(text, '\\') OR contains(text, '<|')
                    THEN length(replace(replace(text, '\', '\\'), '<|', '<\|'))
                ELSE length(text) END AS body
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + body + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
               true AS identical
        FROM turns GROUP BY conv_id
    """,
    "op11_periodic_runs": rf"""
        WITH RECURSIVE {_CRC_TABLE}, given AS (
            SELECT row_number() OVER () AS line, doc_id, {_crc("doc_id::VARCHAR")}::BIGINT AS h,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents, crc_table
        ), placed AS (
            SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given
        ), texts AS (
            SELECT line, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i:
                       w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + (h // 10) % 8)) END]) END AS w
            FROM placed
        ), grams AS (
            SELECT line, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS gram
            FROM (SELECT line, w, unnest(range(greatest(len(w) - 15, 0))) AS i FROM texts)
        ), pairs AS (
            SELECT x.line, x.i, y.i - x.i AS q FROM grams x JOIN grams y USING (line, gram) WHERE x.i < y.i
        ), islands AS (
            SELECT line, q, min(i) AS start, count(*) + 15 + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY line, q ORDER BY i) AS island FROM pairs)
            GROUP BY line, q, island HAVING count(*) + 15 + q >= greatest(24, 3 * q)
        ), runs AS (
            SELECT line, start, length, min(q) AS period FROM islands GROUP BY line, start, length
        ), best AS (
            SELECT * FROM runs
            QUALIFY row_number() OVER (PARTITION BY line ORDER BY length::DOUBLE / period DESC, start, period) = 1
        ), told AS (
            SELECT line, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
            FROM runs GROUP BY line
        ), dropped AS (
            SELECT DISTINCT line, unnest(range(start + period, start + length)) AS i FROM runs
        ), collapsed AS (
            SELECT line, string_agg(word, ' ' ORDER BY i) AS text
            FROM (SELECT line, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts) ANTI JOIN dropped USING (line, i)
            GROUP BY line
        )
        SELECT doc_id, coalesce(n, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
        FROM texts LEFT JOIN told USING (line) LEFT JOIN best USING (line) LEFT JOIN collapsed USING (line)
    """,
    "op12_repeats": """
        WITH texts AS (
            SELECT row_number() OVER () AS line, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), strings AS (
            SELECT line, i, md5(substr(h, 2 * i + 1, 400)) AS s
            FROM (SELECT line, h, unnest(range(greatest(len(h) // 2 - 199, 0))) AS i FROM texts)
        ), again AS (
            SELECT line, i, i - lag(i) OVER (PARTITION BY line ORDER BY i) AS step
            FROM strings SEMI JOIN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1) USING (s)
        ), spans AS (
            SELECT line, min(i) AS first, max(i) + 200 AS stop
            FROM (SELECT *, count(*) FILTER (step IS NULL OR step > 200) OVER (PARTITION BY line ORDER BY i) AS span FROM again)
            GROUP BY line, span
        ), gaps AS (
            SELECT line, first, stop, coalesce(lag(stop) OVER (PARTITION BY line ORDER BY first), 0) AS gap FROM spans
        ), left_over AS (
            SELECT line, count(*) AS n, sum(stop - first) AS removed, max(stop) AS tail,
                   string_agg(substr(h, 2 * gap + 1, 2 * (first - gap)), '' ORDER BY first) AS kept
            FROM gaps JOIN texts USING (line) GROUP BY line
        )
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
               sha256(unhex(coalesce(kept || substr(h, 2 * tail + 1), h))) AS kept_sha256
        FROM texts LEFT JOIN left_over USING (line)
    """,
    "op13_resample": rf"""
        WITH RECURSIVE {_CRC_TABLE}, words AS (
            SELECT row_number() OVER () AS line, doc_id, mine, list_filter(string_split(regexp_replace(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
            FROM (SELECT doc_id, text, true AS mine FROM documents UNION ALL SELECT NULL, text, false FROM benchmark)
        ), features AS (
            SELECT line, mine, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words
        ), hashed AS (
            SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM features), crc_table
        ), counted AS (
            SELECT bucket, count(*) FILTER (mine) AS s, count(*) FILTER (NOT mine) AS t
            FROM features JOIN hashed USING (f) GROUP BY bucket
        ), whole AS (
            SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM counted
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
            FROM counted, whole
        ), weights AS (
            SELECT line, count(*) AS n_features, sum(gain)::BIGINT AS total
            FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE mine GROUP BY line
        ), scored AS (
            SELECT line, doc_id, len(w) AS n, coalesce(n_features, 0) AS n_features,
                   coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
                   floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
            FROM words LEFT JOIN weights USING (line) WHERE mine
        ), ranked AS (
            SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
                   count(*) FILTER (n >= 20) OVER () AS able
            FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n >= 20 AND place <= 25 * able // 100 THEN place END AS rank
        FROM ranked
    """,
}
