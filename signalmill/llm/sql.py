"""DuckDB equivalents of the text operators that SQL can express."""

from __future__ import annotations

from signalmill.llm import licenses, quality

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def quality_rules() -> str:
    fail_bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality.RULES)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS l FROM t),
starts AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 7]) AS n FROM starts),
covered AS (SELECT r, sum(least(8, i - coalesce(before, -7))) AS n FROM (
    SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM windows WHERE n > 1) x GROUP BY r),
measured AS (SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(text, '{_BLANK}+', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(list_distinct(w)) AS n_distinct_words,
    length(regexp_replace(text, '\\P{{L}}+', '', 'g')) AS n_letters,
    len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_upper,
    len(regexp_extract_all(text, '!')) AS n_exclaims FROM words LEFT JOIN covered USING (r)),
entries AS (SELECT *, ({fail_bits})::BIGINT AS fail_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    fail_bits & {quality.BASE.mask} <> 0 AS base_failed, fail_bits & {quality.POLICIES[-1].mask} = 0 AS kept, fail_bits
FROM entries"""


def mix_sources() -> str:
    draw = "('0x' || substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 12))::BIGINT"
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size,
    ({draw} + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
c AS (SELECT *, ((place - 1) % 3 + 1)::DOUBLE AS weight, (3 * source_size)::DOUBLE AS cap FROM p),
o AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
t AS (SELECT source, source_size, least(cap, max((total - used) / rest) OVER () * weight) AS target FROM o),
e AS (SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS hoped
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, least(3, floor(hoped))::BIGINT AS whole, hoped - floor(hoped) AS p FROM e),
g AS (SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS rank,
    target - sum(whole * size) OVER (PARTITION BY source) AS missing FROM f),
h AS (SELECT *, coalesce(sum(CASE WHEN whole < 3 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
k AS (SELECT *, max(CASE WHEN size > 0 AND before + size / 2 <= missing THEN rank END) OVER (PARTITION BY source) AS cut FROM h)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM (
    SELECT *, whole + CASE WHEN whole < 3 AND size > 0 AND coalesce(rank <= cut, false) THEN 1 ELSE 0 END AS copies FROM k) x"""


def license_scan() -> str:
    known = licenses.sentence_ids()
    names, ids = list(known), list(known.values())
    quoted = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    hits = ", ".join(
        f"CASE WHEN contains(line, ',{','.join(str(known[p]) for p in licenses.rule_sentences(r))},') THEN '{r.license}' END"
        for r in licenses.RULES
    )
    assert ids == list(range(1, len(ids) + 1))
    return f"""
WITH cut AS (SELECT doc_id, list_filter(list_transform(
    string_split(regexp_replace(coalesce(text, ''), '[.!?]+([\\x20\\x09-\\x0D]|\\z)', chr(10), 'g'), chr(10)),
    lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS s FROM documents),
found AS (SELECT doc_id, len(s)::BIGINT AS n_sentences, list_filter(list_transform(s,
    lambda x: list_position({quoted}, x)), lambda i: i > 0) AS ids FROM cut),
lined AS (SELECT *, ',' || array_to_string(ids, ',') || ',' AS line FROM found),
hit AS (SELECT *, list_filter([{hits}], lambda h: h IS NOT NULL) AS hits FROM lined)
SELECT doc_id, n_sentences, len(hits)::BIGINT AS n_matches, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
    coalesce(array_to_string(list_sort(list_distinct(hits)), ','), '') AS licenses FROM hit"""


def _added_signs(text: str) -> str:
    """Signs that escaping adds: one per backslash, per place where an opener's mark begins, and per closer."""
    marks = f"list_sum(list_transform(regexp_extract_all({text}, '#{{3,}}'), lambda m: length(m) - 2))"
    return f"(length({text}) - length(replace({text}, chr(92), '')) + coalesce({marks}, 0) + len(regexp_extract_all({text}, '</turn>')))"


def chat_formatting() -> str:
    name = f"""CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9
        ELSE 5 + length(role) + {_added_signs("role")} + length(role) - length(replace(role, chr(10), '')) END"""
    says = "chr(92) || '### Assistant: </turn> ok'"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', {says} UNION ALL SELECT -7, 1, 'assistant', {says}),
m AS (SELECT *, 4 + {name} + 2 + length(text) + {_added_signs("text")} + 8 AS chars FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned
    FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars
FROM c"""


def phrase_collocations(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS words
    FROM w, range(1, {longest} + 1) x(k) WHERE len(w) >= k),
f AS (SELECT lang, k, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {least}),
cut AS (SELECT lang, k, words, f, unnest(range(1, k)) AS j FROM f WHERE k > 1),
scored AS (SELECT cut.*, l.f AS l, r.f AS r, s.n, (1000::HUGEINT * cut.f * s.n) // (l.f::HUGEINT * r.f) AS score
    FROM cut JOIN s USING (lang)
    JOIN f l ON l.lang = cut.lang AND l.words = cut.words[1:j] JOIN f r ON r.lang = cut.lang AND r.words = cut.words[j + 1:]),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1),
inside AS (SELECT lang, words[:k - 1] AS words, f FROM f WHERE k > 2 UNION ALL SELECT lang, words[2:], f FROM f WHERE k > 2),
whole AS (SELECT * FROM weakest ANTI JOIN inside ON inside.lang = weakest.lang AND inside.words = weakest.words AND inside.f >= weakest.f),
ranked AS (SELECT *, array_to_string(words, ' ') AS phrase FROM whole)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r, n::BIGINT AS n,
    score::BIGINT AS score FROM ranked QUALIFY rank <= {top}"""
