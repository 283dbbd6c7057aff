"""DuckDB statements for the queries that SQL can express, written from their meaning."""

from __future__ import annotations

_ESCAPED = r"regexp_replace({0}, '([<\[])(/?s>|/?INST\]|</?SYS>>)|(\\)', '\1\\\2\3', 'g')"

ORACLES: dict[str, str] = {}

ORACLES["op2_chat_windows"] = rf"""
    WITH turns AS (
        SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    coded AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
               length('<s>[INST]' || {_ESCAPED.format('role')} || '[/INST]' || {_ESCAPED.format('text')}
                      || '</s>') AS chars
        FROM turns),
    sized AS (SELECT *, (chars + 3) // 4 AS size FROM coded),
    summed AS (
        SELECT *, CAST(COALESCE(SUM(size) OVER (
                   PARTITION BY conv_id ORDER BY place
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
        FROM sized),
    spans AS (
        SELECT *, before * 2 // 1024 AS span, place = 1 AND role = 'system' AS is_system FROM summed),
    ahead AS (
        SELECT *, lead(span, 1) OVER w AS one, lead(span, 2) OVER w AS two
        FROM spans WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
    windows AS (SELECT DISTINCT conv_id, span AS win FROM spans),
    pieces AS (
        SELECT conv_id, place, span AS win, chars, size, before, TRUE AS fresh, is_system FROM spans
        UNION ALL
        SELECT a.conv_id, place, win, chars, size, before, FALSE, is_system
        FROM ahead a JOIN windows w ON w.conv_id IS NOT DISTINCT FROM a.conv_id
        WHERE win <> span AND (is_system OR win = one OR win = two)),
    bounds AS (
        SELECT conv_id, win, MAX(before + size) AS ends,
               SUM(CASE WHEN is_system THEN size ELSE 0 END) AS fixed
        FROM pieces GROUP BY ALL),
    written AS (
        SELECT p.conv_id, SUM(chars) AS formatted_chars, COUNT(DISTINCT p.win) AS n_windows
        FROM pieces p JOIN bounds b ON b.conv_id IS NOT DISTINCT FROM p.conv_id AND b.win = p.win
        WHERE fresh OR is_system OR ends - before + fixed <= 1024 GROUP BY ALL),
    said AS (
        SELECT conv_id, COUNT(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
               COALESCE(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learned
        FROM coded GROUP BY ALL)
    SELECT s.conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
           sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars, n_windows
    FROM said s JOIN written w ON w.conv_id IS NOT DISTINCT FROM s.conv_id"""

ORACLES["op9_near_duplicates"] = r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    sets AS (
        SELECT doc_id, CASE
                   WHEN len(words) >= 4 THEN list_distinct(list_transform(
                       range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))
                   WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
        FROM split),
    each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS x, any_value(b.n) AS y, COUNT(*) AS common
        FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (x + y - common)),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
    least AS (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY 1)
    SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
           s.doc_id = component_id AS kept
    FROM sets s JOIN least l ON l.doc_id = s.doc_id"""

_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                            lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

ORACLES["op11_periodic_runs"] = rf"""
    WITH given AS (
        SELECT row_number() OVER () AS row, doc_id, {_CRC} AS crc,
               regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    sized AS (SELECT *, CAST(len(words) AS BIGINT) AS n, crc // 10 AS part FROM given),
    based AS (SELECT *, CASE WHEN n > 0 THEN part % n END AS a FROM sized),
    looped AS (
        SELECT row, doc_id, n, CASE WHEN crc % 10 = 0 AND n > 0 THEN list_transform(
                   range(n), lambda i: words[1 + CASE WHEN i < a THEN i
                                             ELSE a + (i - a) % (1 + (n - a) // (3 + part % 8)) END])
               ELSE words END AS words
        FROM based),
    each AS (SELECT row, unnest(words) AS word, unnest(range(n)) AS i FROM looped),
    sixes AS (
        SELECT row, unnest(list_transform(range(n - 5), lambda i: array_to_string(words[i + 1:i + 6], ' '))) AS six,
               unnest(range(n - 5)) AS i
        FROM looped WHERE n >= 12),
    met AS (
        SELECT b.row, b.i - a.i AS lag, b.i FROM sixes a JOIN sixes b
        ON a.row = b.row AND a.six = b.six AND a.i < b.i),
    placed AS (SELECT *, i - row_number() OVER (PARTITION BY row, lag ORDER BY i) AS island FROM met),
    matches AS (
        SELECT row, lag, MIN(i) - lag AS start, COUNT(*) + 5 AS size FROM placed GROUP BY row, lag, island),
    runs AS (
        SELECT row, start, size + lag AS length, MIN(lag) AS period FROM matches
        WHERE size >= GREATEST(lag, 12 - lag) GROUP BY row, start, size + lag),
    written AS (
        SELECT row, COUNT(*) AS n_runs,
               string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY row),
    longest AS (
        SELECT * FROM runs
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY length DESC, start, period) = 1),
    dropped AS (
        SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
    rest AS (
        SELECT row, string_agg(word, ' ' ORDER BY i) AS kept
        FROM each e ANTI JOIN dropped d USING (row, i) GROUP BY row)
    SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, start, length, period,
           1000 * length // period AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256,
           sha256(COALESCE(kept, '')) AS collapsed_sha256
    FROM looped LEFT JOIN written USING (row) LEFT JOIN longest USING (row) LEFT JOIN rest USING (row)"""

ORACLES["op13_search"] = r"""
    WITH split AS (
        SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    held AS (SELECT row, doc_id, terms, len(terms) AS n FROM split WHERE len(terms) > 0),
    whole AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS words FROM held),
    item_terms AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    each AS (SELECT row, doc_id, n, unnest(terms) AS term FROM held),
    counted AS (
        SELECT row, doc_id, n, term, COUNT(*) AS tf FROM each
        WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
        FROM counted, whole GROUP BY term, docs),
    parts AS (
        SELECT row, doc_id, term,
               (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)) AS part
        FROM counted, whole),
    scored AS (
        SELECT item_id, row, doc_id, CAST(SUM(w * part) AS BIGINT) AS score
        FROM parts JOIN item_terms USING (term) JOIN weights USING (term) GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (
               PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10"""
