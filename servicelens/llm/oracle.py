"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from servicelens.llm import chat, decontaminate, embedding_dedup, license_scan, merkle, periodic, quality, warc

# The same words as the operators': runs without ASCII blanks, lower case of A-Z alone.
BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# A phrase between word borders: marks and blanks are doubled first, so that
# two phrases never need the same character as their border.
_BORDER = r"[^\p{L}\p{M}\p{N}_]"
_PHRASES = "(?i)(?:^|{0})({1})(?:$|{0})".format(_BORDER, "|".join(p.replace(" ", "  ") for p in quality.BOILERPLATE))

QUALITY = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, {BLANK_WORDS.format("coalesce(text, '')")} AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i FROM d WHERE len(words) >= {quality.WINDOW})
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM windows) WHERE k > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(i, i + {quality.WINDOW})) AS place FROM twice) GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, {BLANK_WORDS.format("line")} AS lw FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
), judged AS (
    SELECT *, len(lw) AS n,
        len(list_filter(lw, lambda w: w IN ({", ".join(map(_quoted, quality.SEPARATORS))}))) AS seps,
        len(regexp_extract_all(line, '{quality.SYMBOLS}')) + len(regexp_extract_all(line, '!!+'))
            + len(list_filter(range(2, len(lw) + 1), lambda i: lw[i] = lw[i - 1])) AS noise,
        list_sum(list_transform(regexp_extract_all(regexp_replace(line, '({_BORDER})', '\1\1', 'g'), {_quoted(_PHRASES)}, 1),
            lambda phrase: len(string_split(phrase, '  ')))) AS phrase_words
    FROM lines
), verdicts AS (
    SELECT *, n > 0 AND (
        (seps > 0 AND 4 * seps >= n)
        OR 100 * noise > {quality.MAX_NOISE} * n
        OR (n < {quality.SHORT_LINE} AND NOT regexp_matches(line, {_quoted(quality.END_MARKS)}))
        OR coalesce(100 * phrase_words >= {quality.MIN_PHRASE} * n, false)
    ) AS removed
    FROM judged
), by_lines AS (
    SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_dup_lines,
        count(*) FILTER (removed) AS lines_removed, coalesce(sum(n) FILTER (removed), 0) AS words_lost
    FROM verdicts GROUP BY doc_id
), counts AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '{quality.SYMBOLS}'))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words, lines_removed::BIGINT AS lines_removed, words_lost::BIGINT AS words_lost
    FROM d JOIN by_lines USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT} * n_words AS base_failed,
    NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT} * n_words)
        AND 100 * words_lost <= {quality.MAX_LOST} * n_words AS kept
FROM counts
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, {BLANK_WORDS.format(ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS grams
    FROM d
), g AS (
    SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
    FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs WHERE 100 * k >= 80 * (na + nb - k)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM s
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

_BASE32 = " || ".join(
    f"substr('{warc.BASE32}', ((CAST('0x' || substr(hex, {5 * i + 1}, 5) AS INT) >> {shift}) & 31) + 1, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), o AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex) AS original FROM p
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM o
"""


def _escapes(text: str) -> str:
    """Characters that escaping adds."""
    return rf"(length({text}) - length(replace({text}, '\', '')) + len(regexp_extract_all({text}, '<\||</?s>|\[/?INST\]')))"


CHAT = rf"""
WITH m AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum({len(chat.TURN) + len(chat.END) + 1} + length(role) + {_escapes("role")} + length(role) - length(replace(role, chr(10), ''))
        + length(text) + {_escapes("text")})::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""


def _license_scan() -> str:
    """The operator's rules over tables of words and template pairs."""
    rows = []
    for passage, templates in ((False, license_scan.PHRASES), (True, license_scan.PASSAGES)):
        for template, label in templates.items():
            pairs = license_scan.voting_pairs(template, passage)
            rows += [f"({_quoted(a)}, {_quoted(b)}, {_quoted(template)}, {i}, {len(pairs)}, '{label}', {passage})" for a, b, i in pairs]
    words = ASCII_LOWER.format("coalesce(text, '')")
    return rf"""
WITH t(w0, w1, template, t_pos, t_votes, label, passage) AS (VALUES {", ".join(rows)}),
d AS (
    SELECT doc_id, regexp_extract_all({words}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (
    SELECT doc_id, w[i] AS w0, w[i + 1] AS w1, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
), diagonals AS (
    SELECT doc_id, template, t_votes, label, passage, pos - t_pos AS diagonal, list(DISTINCT t_pos) AS voted, min(pos) AS first, max(pos) AS last
    FROM p JOIN t USING (w0, w1) GROUP BY ALL
), banded AS (
    SELECT *, list(voted) OVER (PARTITION BY doc_id, template ORDER BY diagonal
        RANGE BETWEEN {license_scan.MAX_SHIFT} PRECEDING AND {license_scan.MAX_SHIFT} FOLLOWING) AS band FROM diagonals
), marked AS (
    SELECT *, CASE WHEN coalesce(NOT passage OR abs(diagonal - lag(diagonal) OVER o) > {license_scan.MAX_SHIFT}
        OR first - lag(last) OVER o > {license_scan.MAX_SHIFT + 1}, true) THEN 1 ELSE 0 END AS apart
    FROM banded WINDOW o AS (PARTITION BY doc_id, template ORDER BY first, diagonal)
), spanned AS (
    SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY first, diagonal) AS span FROM marked
), spans AS (
    SELECT doc_id, t_votes, label, passage, template, span, min(diagonal) AS start,
        greatest(len(list_distinct(flatten(list(voted)))), max(CASE WHEN passage THEN len(list_distinct(flatten(band))) ELSE 0 END)) AS votes
    FROM spanned GROUP BY ALL
), found AS (
    SELECT *, votes / t_votes AS cover FROM spans WHERE CASE WHEN passage THEN votes / t_votes >= {license_scan.MIN_COVER} ELSE votes = t_votes END
)
SELECT d.doc_id, any_value(len(w))::BIGINT AS n_words, count(*) FILTER (NOT passage) AS n_base,
    min(start) FILTER (NOT passage)::BIGINT AS first_word, max(start) FILTER (NOT passage)::BIGINT AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (NOT passage), '') AS base_labels,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0)::DOUBLE AS score
FROM d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""


def _decontamination() -> str:
    """The operator's rules with lists of words in place of hashes."""
    d = decontaminate
    values = lambda words: ", ".join(map(_quoted, words))
    width = d.WINDOW
    canon = f"""list_transform(words, lambda w, i: CASE
        WHEN w >= '0' AND w < ':' THEN '<number>'
        WHEN ((w >= 'A' AND w < '[') OR (w >= 'À' AND w < 'ß')) AND i > 1 AND right(raw[i - 1], 1) NOT IN ({values(d.SENTENCE_MARKS)}) THEN '<name>'
        WHEN lower(w) IN ({values(d.NUMBER_WORDS)}) THEN '<number>'
        WHEN lower(w) IN ({values(d.UNITS)}) THEN '<unit>'
        ELSE lower(w) END)"""

    def windows(table: str, key: str) -> str:
        return f"""
    SELECT id, n, i - 1 AS pos, words[i:i + {width - 1}] AS words, canon[i:i + {width - 1}] AS canon,
        array_to_string(canon[i:i + {width - 1}], chr(1)) AS gram
    FROM (
        SELECT *, unnest(range(1, n + 1)) AS i FROM (
            SELECT id, words, {canon} AS canon, CASE WHEN len(words) = 0 THEN 0 ELSE greatest(1, len(words) - {width - 1}) END AS n
            FROM (
                SELECT id, raw, list_transform(raw, lambda w: CASE WHEN trim(w, {_quoted(d.ARITHMETIC_MARKS)}) = '' THEN w
                    ELSE trim(w, {_quoted(d.OUTER_MARKS)}) END) AS words
                FROM (SELECT {key} AS id, {BLANK_WORDS.format("coalesce(text, '')")} AS raw FROM {table})
            )
        )
    )"""

    return f"""
WITH dw AS ({windows("documents", "doc_id")}), bw AS ({windows("benchmark", "item_id")}),
hits AS (
    SELECT dw.id AS doc_id, bw.id AS item_id, bw.n AS n_windows, dw.pos AS pos, bw.pos AS t_pos,
        list_filter(
            list_transform(bw.canon, lambda c, j: {{'kind': c, 'theirs': bw.words[j], 'ours': dw.words[j]}}),
            lambda x: x.kind IN ({values(d.KINDS)})
        ) AS slots,
        len(list_filter(bw.canon, lambda c: c NOT IN ({values(d.KINDS)}) AND trim(c, {_quoted(d.OUTER_MARKS)}) <> '')) > 0 AS ordinary
    FROM dw JOIN bw USING (gram)
), diagonals AS (
    SELECT doc_id, item_id, n_windows, pos - t_pos AS diagonal, list(DISTINCT t_pos) AS covered, flatten(list(slots)) AS slots, bool_or(ordinary) AS ordinary,
        min(pos) AS first, max(pos) AS last
    FROM hits GROUP BY ALL
), marked AS (
    SELECT *, CASE WHEN coalesce(abs(diagonal - lag(diagonal) OVER o) > {d.MAX_SHIFT} OR first - lag(last) OVER o > n_windows, true)
        THEN 1 ELSE 0 END AS apart
    FROM diagonals WINDOW o AS (PARTITION BY doc_id, item_id ORDER BY first, diagonal)
), spanned AS (
    SELECT *, sum(apart) OVER (PARTITION BY doc_id, item_id ORDER BY first, diagonal) AS span FROM marked
), spans AS (
    SELECT doc_id, item_id, n_windows, span, len(list_distinct(flatten(list(covered)))) AS k,
        list_distinct(flatten(list(slots))) AS slots, min(first) AS first, max(last) AS last, bool_or(ordinary) AS ordinary
    FROM spanned GROUP BY ALL
), leaks AS (
    SELECT doc_id, item_id, k / n_windows AS cover, first, last,
        len(list_filter(slots, lambda x: x.theirs <> x.ours)) = 0 AS verbatim
    FROM spans
    WHERE k / n_windows >= {d.MIN_COVER} AND (ordinary OR len(list_filter(slots, lambda x: x.theirs <> x.ours)) = 0)
        AND len(list_distinct(list_transform(slots, lambda x: {{'kind': x.kind, 'theirs': x.theirs}}))) = len(slots)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY cover DESC, verbatim DESC, first, last DESC) AS place FROM leaks
)
SELECT doc_id, item_id, cover, first::BIGINT AS first_word, (last + {width - 1})::BIGINT AS last_word,
    CASE WHEN verbatim THEN 'verbatim' ELSE 'reparameterised' END AS kind
FROM ranked WHERE place = 1
"""


# Unsigned crc32 of an ASCII text, bit by bit (fixed value: the reversed polynomial).
CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, zero: xor(c >> 1, (c & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""

PERIODIC = rf"""
WITH d AS (
    SELECT doc_id, {BLANK_WORDS.format("coalesce(text, '')")} AS w, {CRC32.format("doc_id::VARCHAR")} AS h FROM documents
), g AS (
    SELECT doc_id, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS planted FROM d
), a AS (
    SELECT *, CASE WHEN planted THEN g % n END AS a FROM g
), p AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a
), t AS (
    SELECT doc_id, n, CASE WHEN planted
        THEN list_transform(range(n), lambda i: w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % p END)]) ELSE w END AS w FROM p
), words AS (
    SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM t
), same AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // {periodic.LEAST_EXPONENT}
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same
), stretches AS (
    SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest({periodic.LEAST_LENGTH}, {periodic.LEAST_EXPONENT} * q) GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id
), longest AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
    (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

EMBEDDINGS = f"""
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), sizes AS (
    SELECT len(e) AS dim FROM rows WHERE e IS NOT NULL GROUP BY dim ORDER BY count(*) DESC, dim DESC LIMIT 1
), sound AS (
    SELECT r, vec_id, e FROM rows WHERE len(e) = (SELECT dim FROM sizes)
        AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.r, b.r AS other FROM sound a JOIN sound b ON a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= {embedding_dedup.THRESHOLD}
), reach AS (
    SELECT r, vec_id AS root FROM rows
    UNION
    SELECT links.other, reach.root FROM reach JOIN links USING (r)
), roots AS (
    SELECT r, min(root) AS root FROM reach GROUP BY r
), counts AS (
    SELECT r, count(*) AS n FROM links GROUP BY r
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root::BIGINT AS component_id, vec_id IS NOT DISTINCT FROM root AS kept
FROM rows JOIN roots USING (r) LEFT JOIN counts USING (r)
"""


def _leaf(text: str) -> str:
    coded = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(coded)})"


def _levels(name: str, base: str) -> str:
    """CTE of all nodes (seg, level, pos, digest, n) over ``base`` (seg, pos, digest, n)."""
    k = merkle.ARITY
    return f"""{name} AS (
    SELECT seg, 0 AS level, pos, digest, n FROM {base}
    UNION ALL
    SELECT seg, level + 1, pos // {k}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {k - 1}) // {k}
    FROM {name} WHERE n > 1 GROUP BY seg, level, pos // {k}, n
)"""


def _steps(nodes: str) -> str:
    """Per node of a level with more than one: the siblings before and after it."""
    return f"""SELECT x.seg, x.level, x.pos, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS before,
        coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS after
    FROM {nodes} x JOIN {nodes} y ON x.seg = y.seg AND x.level = y.level AND x.pos // {merkle.ARITY} = y.pos // {merkle.ARITY}
    WHERE x.n > 1 GROUP BY ALL"""


MERKLE = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('s' || source, 'null') AS seg, source, {_leaf("text")} AS leaf,
        CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY seg ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY seg) AS n FROM d
), base AS (
    SELECT seg, pos, leaf AS digest, n FROM leaves
), {_levels("nodes", "base")}, subroots AS (
    SELECT seg AS name, 'all' AS seg, row_number() OVER (ORDER BY CASE WHEN seg = 'null' THEN 0 ELSE 1 END, seg) - 1 AS pos, digest, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), top_base AS (
    SELECT seg, pos, digest, n FROM subroots
), {_levels("tops", "top_base")}, steps AS (
    {_steps("nodes")}
), top_steps AS (
    {_steps("tops")}
), powers AS (
    SELECT range AS level, ({merkle.ARITY} ** range)::BIGINT AS power FROM range(40)
), path AS (
    SELECT l.seg, l.pos, s.level, s.before, s.after FROM leaves l JOIN steps s ON l.seg = s.seg
        JOIN powers p ON p.level = s.level AND s.pos = l.pos // p.power
    UNION ALL
    SELECT l.seg, l.pos, 1000 + s.level, s.before, s.after FROM leaves l JOIN subroots r ON r.name = l.seg JOIN top_steps s ON true
        JOIN powers p ON p.level = s.level AND s.pos = r.pos // p.power
), proofs AS (
    SELECT seg, pos, list({{'before': before, 'after': after}} ORDER BY level) AS steps FROM path GROUP BY seg, pos
), folded AS (
    SELECT l.seg, l.pos, l.claimed AS digest, 1 AS place, p.steps FROM leaves l LEFT JOIN proofs p USING (seg, pos)
    UNION ALL
    SELECT seg, pos, sha256(steps[place].before || digest || steps[place].after), place + 1, steps FROM folded WHERE place <= len(steps)
), ended AS (
    SELECT seg, pos, digest, coalesce(array_to_string(list_transform(steps, lambda s: s.before || s.after), ''), '') AS proof
    FROM folded WHERE place > coalesce(len(steps), 0)
), root AS (
    SELECT digest AS root FROM tops WHERE n = 1
)
SELECT doc_id, leaf, r.digest AS subroot, root, sha256(proof) AS proof_sha256, e.digest AS folded_root, e.digest = root AS verified
FROM leaves l JOIN ended e USING (seg, pos) JOIN subroots r ON r.name = l.seg, root
"""


ORACLE: dict[str, str] = {
    "op2_warc_revisits": WARC,
    "op3_license_scan": _license_scan(),
    "op6_near_duplicates": NEAR_DUPLICATES,
    "op7_quality_rules": QUALITY,
    "op9_decontamination": _decontamination(),
    "op10_chat_format": CHAT,
    "op11_periodic_runs": PERIODIC,
    "op12_embedding_duplicates": EMBEDDINGS,
    "op13_merkle_manifest": MERKLE,
}
