"""SQL of the operators' results, for the engine that checks them.

Each statement says plainly what the operator computes at scale: all windows,
all shared shingles, all 100-byte strings.  Texts come from the whole tables.
"""

from __future__ import annotations

from . import quality

LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BLANK = r"\x20\x09-\x0D"

DECONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {WORDS} AS w FROM benchmark)),
    item_windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)
    ),
    doc_windows AS (
        SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item_windows))
    ),
    found AS (SELECT doc_id, item_id, n, i FROM doc_windows JOIN item_windows USING (n, k)),
    hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

QUALITY = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS w FROM documents),
    m AS (
        SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{BLANK}]')) AS lines,
            len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in sorted(set(quality.STOP_WORDS)))}))) AS stops FROM d
    ),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
    often AS (SELECT doc_id, i FROM windows JOIN (SELECT doc_id, k FROM windows GROUP BY 1, 2 HAVING count(*) > 1) USING (doc_id, k)),
    repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM often) GROUP BY 1),
    j AS (
        SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, stops FROM m LEFT JOIN repeated USING (doc_id)
    ),
    f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM j)
    SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND 100 * n_repeat_words <= 30 * n_words AND word_chars BETWEEN 2 * n_words AND 20 * n_words
        AND 10 * n_symbols <= word_chars AND 2 * n_dup_lines <= n_lines AND 50 * stops >= n_words AND stops >= 2 AS kept
    FROM f
"""

SUFFIXES = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS k FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 99)) AS i FROM d)),
    later AS (SELECT doc_id, i FROM strings QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
    marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS opens FROM later),
    numbered AS (SELECT doc_id, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
    runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS e FROM numbered GROUP BY doc_id, run),
    gaps AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
    cut AS (
        SELECT doc_id, sum(e - a) AS gone, count(*) AS spans, max(e) AS last,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM gaps JOIN d USING (doc_id) GROUP BY 1
    )
    SELECT doc_id, strlen(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
        sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id)
"""

JACCARD = f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format('text')}, '[^{BLANK}]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, least(len(w), 4) AS n, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM d WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared.n >= 85 * (a.n + b.n - shared.n)
    ),
    reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN links ON other = x)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY 1
"""

# The checksum goes byte by byte over the distinct runs of a document, by the table of its polynomial.
SPELLING = f"""
    WITH RECURSIVE bits AS (
        SELECT CAST(b AS BIGINT) AS byte, CAST(b AS BIGINT) AS v, 0 AS turn FROM range(256) t(b)
        UNION ALL SELECT byte, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, turn + 1 FROM bits WHERE turn < 8
    ),
    steps AS (SELECT byte, v FROM bits WHERE turn = 8),
    runs AS (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents
        ) GROUP BY 1, 2
    ),
    sums AS (
        SELECT doc_id, run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h, 0 AS done, 4294967295 AS crc FROM runs
        UNION ALL SELECT doc_id, run, h, done + 1, xor(crc // 256, v)
        FROM sums JOIN steps ON byte = xor(crc % 256, CAST('0x' || substr(h, 2 * done + 1, 2) AS BIGINT)) WHERE 2 * done < strlen(h)
    ),
    checked AS (SELECT doc_id, run, xor(crc, 4294967295) AS sum FROM sums WHERE 2 * done = strlen(h)),
    spelled AS (
        SELECT CASE WHEN sum % 97 = 0 THEN substr(run, 1, sum % length(run)) || substr(run, sum % length(run) + 2) ELSE run END AS word, n
        FROM runs JOIN checked USING (doc_id, run)
    ),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
    places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
    holes AS (SELECT DISTINCT word, substr(word, 1, i - 1) || '.' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
    near AS (
        SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
        UNION SELECT holes.word, words.word FROM holes JOIN words ON less = words.word
        UNION SELECT words.word, holes.word FROM holes JOIN words ON less = words.word
    ),
    ranked AS (
        SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
            row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place FROM near JOIN words ON other = words.word
    ),
    formed AS (
        SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 2 * words.n THEN other END AS form,
            CASE WHEN ranked.n >= 2 * words.n THEN ranked.n END AS form_n
        FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1
    ),
    climb AS (
        SELECT word, word AS root FROM formed
        UNION ALL SELECT climb.word, formed.form FROM climb JOIN formed ON climb.root = formed.word WHERE formed.form IS NOT NULL
    ),
    tops AS (SELECT climb.word, climb.root FROM climb JOIN formed ON climb.root = formed.word WHERE formed.form IS NULL)
    SELECT formed.word AS word, form, root, n, n_near, form_n FROM formed JOIN tops ON tops.word = formed.word
"""
