"""DuckDB SQL with the rows of those operators that SQL can express, over whole tables."""

from __future__ import annotations

from collections.abc import Mapping

from eodledger.llm import mixing, quality_rules

BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def mix(weights: Mapping[str, int], block: int = mixing.BLOCK) -> str:
    """Slots one after the other by earliest deadline, then the place of each document by its rank."""
    named = " ".join(f"WHEN '{s}' THEN {w}" for s, w in weights.items())
    return f"""WITH RECURSIVE s AS (
      SELECT row_number() OVER (ORDER BY source NULLS FIRST) AS i, source, CASE source {named} ELSE 1 END::BIGINT AS w, count(*) AS total
      FROM documents GROUP BY source),
    period AS (SELECT sum(w)::BIGINT AS slots FROM s),
    run AS (
      SELECT -1::BIGINT AS slot, 0::BIGINT AS i, (SELECT list(0::BIGINT ORDER BY i) FROM s) AS done
      UNION ALL
      SELECT slot, i, list_transform(done, lambda x, k: x + CASE WHEN k = i THEN 1 ELSE 0 END) FROM (
        SELECT run.slot + 1 AS slot, done, arg_min(s.i, ((done[s.i] + 1) * slots + w - 1) // w * 1000000 + s.i) AS i
        FROM run, period, s WHERE run.slot + 1 < slots AND done[s.i] * slots // w <= run.slot + 1
        GROUP BY run.slot, done)),
    plan AS (SELECT i, slot AS place, row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS k FROM run WHERE i > 0),
    ends AS (SELECT min((total // {block}) // w * slots + place) AS first_empty FROM s JOIN plan USING (i), period WHERE k = (total // {block}) % w),
    ranked AS (
      SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, ''))) - 1 AS r FROM documents),
    placed AS (
      SELECT doc_id, d.source, (r // {block}) // w * slots + place AS slot, r % {block} AS within
      FROM ranked d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN plan ON plan.i = s.i AND k = (r // {block}) % w, period)
    SELECT doc_id, source, slot, slot * {block} + within AS position, slot < first_empty AS in_mix FROM placed, ends"""


def _chance() -> str:
    """The posterior of pattern ``p`` under the model in the row."""
    odds = [
        f"CASE substr(p, {j}, 1) WHEN 'g' THEN greatest({quality_rules.LEAST_GOOD}e0, ln(gg[{j}] / bg[{j}])) "
        f"WHEN 'b' THEN -greatest({quality_rules.LEAST_BAD}e0, ln(bb[{j}] / gb[{j}])) ELSE 0e0 END"
        for j in range(1, len(quality_rules.RULES) + 1)
    ]
    return f"1 / (1 + exp(-(ln(good / (1 - good)) + {' + '.join(odds)})))"


def _within(share: str) -> str:
    return f"least({quality_rules.HIGH}e0, greatest({quality_rules.LOW}e0, {share}))"


def quality(least: float = 0.5) -> str:
    """Counts of each text, votes, and expectation maximisation as a recursion over one row."""
    q, k = quality_rules, len(quality_rules.RULES)
    votes = " || ".join(f"CASE WHEN {r.bad} THEN 'b' WHEN {r.good} THEN 'g' ELSE '-' END" for r in q.RULES)

    def shares(of: str, vote: str, first: float) -> str:
        one = lambda j: f"({q.PRIOR * first}e0 + sum(CASE WHEN substr(p, {j}, 1) = '{vote}' THEN {of} ELSE 0e0 END)) / (sum({of}) + {q.PRIOR}e0)"
        return "[" + ", ".join(_within(one(j)) for j in range(1, k + 1)) + "]"

    first = ", ".join(
        f"[{', '.join([f'{x}e0'] * k)}] AS {name}"
        for name, x in zip(("gb", "bb", "gg", "bg"), (*q.FIRST_BAD_VOTES, *q.FIRST_GOOD_VOTES))
    )
    window = " || ' ' || ".join(f"lead(word, {i}) OVER near" for i in range(q.WINDOW))
    return f"""WITH RECURSIVE d AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
      FROM documents),
    spread AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
    windows AS (SELECT rid, pos, {window} AS w FROM spread WINDOW near AS (PARTITION BY rid ORDER BY pos)),
    twice AS (SELECT rid, pos FROM windows WHERE w IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
    steps AS (SELECT rid, least({q.WINDOW}, coalesce(lead(pos) OVER (PARTITION BY rid ORDER BY pos) - pos, {q.WINDOW})) AS step FROM twice),
    repeats AS (SELECT rid, sum(step)::BIGINT AS n FROM steps GROUP BY rid),
    m AS (
      SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{BLANK}+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper, len(regexp_extract_all(t, '!!({BLANK}|$)')) AS n_shouts,
        len(regexp_extract_all(t, '[.!?:。]({BLANK}|$)')) AS n_ends, len(regexp_extract_all(t, '[#*$%&|<>!]+')) AS n_marks,
        length(regexp_replace(t, '[\\p{{L}}\\p{{N}}\\x20\\x09-\\x0D]+', '', 'g')) AS n_signs, len(list_distinct(words)) AS n_distinct
      FROM d LEFT JOIN repeats USING (rid)),
    voted AS MATERIALIZED (
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * n_words AS base_failed, {votes} AS p FROM m),
    patterns AS MATERIALIZED (SELECT p, count(*)::DOUBLE AS n FROM voted GROUP BY p),
    em AS (
      SELECT 0 AS round, {q.FIRST_GOOD}e0 AS good, {first}
      UNION ALL
      SELECT round + 1, {_within(f"(sum(g) + {q.PRIOR * q.FIRST_GOOD}e0) / (sum(g) + sum(b) + {q.PRIOR}e0)")},
        {shares("g", "b", q.FIRST_BAD_VOTES[0])}, {shares("b", "b", q.FIRST_BAD_VOTES[1])},
        {shares("g", "g", q.FIRST_GOOD_VOTES[0])}, {shares("b", "g", q.FIRST_GOOD_VOTES[1])}
      FROM (SELECT round, p, n * w AS g, n * (1 - w) AS b FROM (SELECT round, p, n, {_chance()} AS w FROM em, patterns WHERE round < {q.ROUNDS}))
      GROUP BY round)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND {_chance()} >= {least} AS kept, p AS votes
    FROM voted, em WHERE round = {q.ROUNDS}"""


#: Every inner product of whole-number vectors, which doubles hold exactly.
TOP_K = """WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
    SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 20"""


def _h(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_h(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Level after level by recursion, with the steps of each leaf read off the runs; CRC-32 bit by bit.
MANIFEST = f"""WITH RECURSIVE d AS MATERIALIZED (
      SELECT doc_id, lang, {_leaf()} AS leaf, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_leaf()}) - 1 AS place,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered, source, n_chars, text
      FROM documents),
    c AS MATERIALIZED (
      SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
          lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc
      FROM d),
    again AS (
      SELECT row_number() OVER () AS id, doc_id, lang, place, leaf,
        CASE WHEN crc % 3 = 0 THEN {_leaf("lowered")} ELSE leaf END AS changed FROM c),
    nodes AS (
      SELECT lang, 0 AS level, place AS idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM d
      UNION ALL
      SELECT lang, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 7) // 8)
      FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8),
    subs AS MATERIALIZED (SELECT lang, level, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1),
    tops AS (
      SELECT 0 AS level, place AS idx, h, count(*) OVER () AS n FROM subs
      UNION ALL
      SELECT level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 7) // 8) FROM tops WHERE n > 1 GROUP BY level, idx // 8),
    kids AS MATERIALIZED (
      SELECT false AS top, lang, level, idx, list(h ORDER BY pos) AS hs FROM (SELECT lang, level, idx // 8 AS idx, idx AS pos, h FROM nodes WHERE n > 1) GROUP BY ALL
      UNION ALL
      SELECT true, NULL, level, idx, list(h ORDER BY pos) FROM (SELECT level, idx // 8 AS idx, idx AS pos, h FROM tops WHERE n > 1) GROUP BY ALL),
    steps AS (
      SELECT a.id, k.top, k.level, k.hs, (a.place // (8 ** k.level)::BIGINT) % 8 AS j
      FROM again a JOIN kids k ON NOT k.top AND k.lang IS NOT DISTINCT FROM a.lang AND k.idx = a.place // (8 ** (k.level + 1))::BIGINT
      UNION ALL
      SELECT a.id, true, k.level, k.hs, (s.place // (8 ** k.level)::BIGINT) % 8
      FROM again a JOIN subs s ON s.lang IS NOT DISTINCT FROM a.lang JOIN kids k ON k.top AND k.idx = s.place // (8 ** (k.level + 1))::BIGINT),
    cut AS (
      SELECT id, list({{'l': array_to_string(hs[:j], ''), 'r': array_to_string(hs[j + 2:], '')}} ORDER BY top, level) AS path FROM steps GROUP BY id),
    folded AS (
      SELECT a.*, s.h AS subroot, coalesce(path, []) AS path FROM again a JOIN subs s ON s.lang IS NOT DISTINCT FROM a.lang LEFT JOIN cut USING (id)),
    made AS (
      SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root,
        sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
        list_reduce(list_prepend({{'l': '', 'r': changed}}, path), lambda a, b: {{'l': '', 'r': sha256(b.l || a.r || b.r)}}).r AS folded_root
      FROM folded)
    SELECT *, folded_root = root AS verified FROM made"""


#: Words with their places, runs of them by position, and every cut of every candidate.
COLLOCATIONS = """WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
      FROM documents),
    p AS (SELECT id, lang, unnest(pieces) AS piece, unnest(range(len(pieces))) AS at_piece FROM d),
    q AS (SELECT id, lang, at_piece, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
    w AS (SELECT id, lang, at_piece, unnest(words) AS w1, unnest(range(len(words))) AS pos FROM q),
    g AS MATERIALIZED (
      SELECT lang, w1, lead(w1) OVER near AS w2, lead(w1, 2) OVER near AS w3 FROM w WINDOW near AS (PARTITION BY id, at_piece ORDER BY pos)),
    total AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
    u AS MATERIALIZED (SELECT lang, w1 AS p, count(*) AS f FROM g GROUP BY ALL),
    b AS MATERIALIZED (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
    t AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    parts AS MATERIALIZED (SELECT lang, p, f FROM u UNION ALL SELECT lang, p, f FROM b),
    cuts AS (
      SELECT lang, p AS phrase, f AS a, 1 AS k, w1 AS x, w2 AS y FROM b WHERE f >= 10
        AND NOT EXISTS (SELECT 1 FROM t WHERE t.lang = b.lang AND 100 * t.f >= 50 * b.f AND (t.w1 = b.w1 AND t.w2 = b.w2 OR t.w2 = b.w1 AND t.w3 = b.w2))
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 1, w1, w2 || ' ' || w3 FROM t
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, f, 2, w1 || ' ' || w2, w3 FROM t),
    scored AS (
      SELECT c.lang, phrase, a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM cuts c JOIN parts l ON l.lang = c.lang AND l.p = c.x JOIN parts r ON r.lang = c.lang AND r.p = c.y),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best JOIN total USING (lang) QUALIFY rank <= 2000"""


#: The first document of every window, and the words that windows of later documents cover.
REPEATS = """WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (SELECT id, doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM d WHERE doc_id IS NOT NULL),
    w AS MATERIALIZED (SELECT id, doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS passage FROM s),
    f AS (SELECT passage, min(doc_id) AS doc_id FROM w GROUP BY passage),
    gone AS (SELECT DISTINCT id, pos + k AS pos FROM w JOIN f USING (passage), range(13) r(k) WHERE w.doc_id > f.doc_id),
    every AS (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
    kept AS (SELECT id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM every ANTI JOIN gone USING (id, pos) GROUP BY id)
    SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (id)"""
