"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from cohortlens.llm import votes
from cohortlens.llm.urls import LOWERED, UPPER

WORD = r"[^\x20\x09-\x0D]+"
STOPS = f"[{votes.STOPS}]"


def ngram_join(size: int, percent: int) -> str:
    """Every pair of sets that share a shingle compared; components by reachability."""
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERED}'), '{WORD}') AS w
  FROM documents
),
places AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {size - 1}, 1))) AS i
  FROM words WHERE len(w) > 0
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS shingle FROM places
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= {percent} * (x.n + y.n - c)
),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, b FROM reach JOIN ends ON a = other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON node = d.doc_id
GROUP BY d.doc_id, n"""


def _vote(rule: votes.Rule) -> str:
    value = f"CAST({rule.value} AS DOUBLE)"
    cases = ["WHEN n_words = 0 THEN 0"]
    if rule.bad_from < float("inf"):
        cases.append(f"WHEN {value} >= {rule.bad_from} THEN -1")
    if rule.good_below > float("-inf"):
        cases.append(f"WHEN {value} < {rule.good_below} THEN 1")
    return f"CASE {' '.join(cases)} ELSE 0 END"


def _round(number: int) -> str:
    """One round of expectation-maximisation over the patterns of votes."""
    s = votes.SMOOTHING
    weights = []
    for j in range(len(votes.RULES)):
        for v, name in ((1, "g"), (-1, "b")):
            good = f"coalesce(sum(n * q) FILTER (WHERE v{j} = {v}), 0)"
            bad = f"coalesce(sum(n * (1 - q)) FILTER (WHERE v{j} = {v}), 0)"
            weights.append(
                f"ln(({good} + {s}) / (sum(n * q) + {3 * s})"
                f" / (({bad} + {s}) / (sum(n) - sum(n * q) + {3 * s}))) AS w{j}{name}"
            )
    odds = " + ".join(
        f"CASE v{j} WHEN 1 THEN w{j}g WHEN -1 THEN w{j}b ELSE 0 END" for j in range(len(votes.RULES))
    )
    return f"""m{number} AS MATERIALIZED (SELECT {", ".join(weights)} FROM q{number - 1}),
q{number} AS MATERIALIZED (
  SELECT p.*, 1 / (1 + exp(-(ln({votes.PRIOR} / (1 - {votes.PRIOR})) + {odds}))) AS q
  FROM patterns p, m{number}
)"""


def quality_rules() -> str:
    ways = [f"v{j}" for j in range(len(votes.RULES))]
    listed = ", ".join(ways)
    cast = ", ".join(f"{_vote(r)} AS v{j}" for j, r in enumerate(votes.RULES))
    rounds = ",\n".join(_round(i) for i in range(1, votes.ROUNDS + 1))
    scripts = "".join(votes.UNSPACED)
    return f"""WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{WORD}')] AS l
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS window_text
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split)
),
twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, window_text) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k)
  GROUP BY doc_id
),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(array_to_string(w, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(l) AS n_lines,
    length(regexp_replace(array_to_string(w, ''), '[^A-Z]+', '', 'g')) AS n_capitals,
    len([x FOR x IN w IF regexp_matches(x, '{STOPS}$')]) AS n_stops,
    coalesce(list_sum([
      length(regexp_extract(x, '^\\p{{L}}[\\p{{L}}\\p{{M}}]*')) FOR x IN w
      IF regexp_matches(x, '^\\p{{L}}[\\p{{L}}\\p{{M}}]*({STOPS}|$)')
    ]), 0) AS n_plain,
    length(regexp_replace(array_to_string(w, ''), '[^{scripts}]+', '', 'g')) AS n_unspaced
  FROM split LEFT JOIN covered USING (doc_id)
),
voted AS (SELECT *, {cast} FROM counts),
patterns AS MATERIALIZED (
  SELECT {listed}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY {listed}
),
q0 AS MATERIALIZED (
  SELECT *, CASE WHEN least({listed}) = -1 THEN {1 - votes.FIRM}
    WHEN greatest({listed}) = 1 THEN {votes.FIRM} ELSE {votes.PRIOR} END AS q
  FROM patterns
),
{rounds}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND q >= {votes.KEEP_FROM} AS kept
FROM voted JOIN q{votes.ROUNDS} USING ({listed})"""


_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY n) AS crcs FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) numbers(n)
  )
)"""


def _crc32(text: str) -> str:
    """The checksum of an ASCII text, by the table ``crcs``."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {codes}), "
        "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def conversation_repair() -> str:
    """Costs by recursion from the last row, edits by recursion from the first."""
    keep = "CASE WHEN fault = 1 THEN 1000000 ELSE CASE WHEN fault = 2 THEN 5 ELSE 0 END END"
    return f"""WITH RECURSIVE {_CRC_TABLE},
base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM base WHERE kind <> 0
),
placed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS body
  FROM damaged
),
looked AS (
  SELECT *, CASE left(role, 1) WHEN 's' THEN 2 WHEN 'u' THEN 3 WHEN 'a' THEN 4 ELSE 0 END AS class,
    CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS wrong
  FROM (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth FROM placed)
),
coded AS (
  SELECT *, CASE wrong WHEN 'blank' THEN 1 WHEN 'duplicate' THEN 1 WHEN 'truncated' THEN 2 ELSE 0 END AS fault,
    {keep.replace("fault", "CASE wrong WHEN 'blank' THEN 1 WHEN 'duplicate' THEN 1 WHEN 'truncated' THEN 2 ELSE 0 END")} AS t,
    lag(class) OVER (PARTITION BY c ORDER BY i) AS before
  FROM looked
),
sizes AS (SELECT c, any_value(conv_id) AS conv_id, CAST(max(i) AS BIGINT) AS n FROM coded GROUP BY c),
costs(c, i, v) AS (
  SELECT c, n + 1, [0, 10, 5, 0] FROM sizes
  UNION ALL
  SELECT c, i, [least(b[1], 5 + least(b[3], 5 + b[4])), least(b[2], 5 + least(b[3], 5 + b[4])),
    least(b[3], 5 + b[4]), least(b[4], 5 + b[3])]
  FROM (
    SELECT r.c, r.i, [
      least(2 + v[1], 1 + t + v[3], CASE class WHEN 2 THEN t + v[2] WHEN 3 THEN t + v[3] ELSE 1000000 END),
      least(2 + v[2], 1 + t + v[3], CASE class WHEN 3 THEN t + v[3] ELSE 1000000 END),
      least(2 + v[3], 1 + t + v[4], CASE class WHEN 4 THEN t + v[4] ELSE 1000000 END),
      least(2 + v[4], 1 + t + v[3], CASE class WHEN 3 THEN t + v[3] ELSE 1000000 END)] AS b
    FROM costs JOIN coded r ON r.c = costs.c AND r.i = costs.i - 1
  )
),
walk(c, i, state, audit, lines) AS (
  SELECT c, CAST(1 AS BIGINT), 1, '', CAST([] AS VARCHAR[]) FROM sizes
  UNION ALL
  SELECT c, CASE edit WHEN 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN state WHEN 'K' THEN class ELSE follows END,
    audit || edit,
    CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE follows WHEN 3 THEN 'user' ELSE 'assistant' END || ':' ||
        CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM (
    SELECT w.c, w.i, state, audit, lines, r.role, r.text, class, follows,
      CASE WHEN now.v[state] = 2 + later.v[state] THEN 'D'
        WHEN now.v[state] = 5 + now.v[follows] THEN 'I'
        WHEN (class = follows OR (class = 2 AND state = 1)) AND now.v[state] = t + later.v[class] THEN 'K'
        ELSE 'R' END AS edit
    FROM (SELECT *, CASE state WHEN 3 THEN 4 ELSE 3 END AS follows FROM walk) w
    JOIN coded r ON r.c = w.c AND r.i = w.i
    JOIN costs now ON now.c = w.c AND now.i = w.i
    JOIN costs later ON later.c = w.c AND later.i = w.i + 1
  )
),
ended AS (
  SELECT w.c, audit || CASE state WHEN 2 THEN 'II' WHEN 3 THEN 'I' ELSE '' END AS audit,
    sha256(array_to_string(list_concat(lines, CASE state WHEN 2 THEN ['user:', 'assistant:']
      WHEN 3 THEN ['assistant:'] ELSE [] END), chr(10))) AS digest
  FROM walk w JOIN sizes s ON s.c = w.c AND w.i = s.n + 1
),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (wrong = 'blank') AS blank, count(*) FILTER (wrong = 'duplicate') AS duplicate,
    count(*) FILTER (wrong = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND NOT ((before, class) IN ((2, 3), (3, 4), (4, 3)))) AS illegal
  FROM coded GROUP BY c
),
firsts AS (SELECT c, v[1] AS cost FROM costs WHERE i = 1)
SELECT whole.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) whole
LEFT JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM whole.conv_id
LEFT JOIN ended ON ended.c = sizes.c LEFT JOIN counts ON counts.c = sizes.c LEFT JOIN firsts ON firsts.c = sizes.c"""


def substring_dedup(window: int) -> str:
    """Every window beside the first place of its words."""
    return f"""WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
),
places AS (SELECT r, k, w, unnest(range(len(w) - {window - 1})) AS i FROM texts WHERE len(w) >= {window}),
windows AS (SELECT r, k, i, array_to_string(w[i + 1:i + {window}], ' ') AS s FROM places),
firsts AS (SELECT r, k, i, min({{'k': k, 'i': i}}) OVER (PARTITION BY s) AS f FROM windows),
gone AS (
  SELECT DISTINCT r, i + unnest(range({window})) AS i FROM firsts WHERE {{'k': k, 'i': i}} > f
),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
kept AS (
  SELECT words.r, string_agg(word, ' ' ORDER BY words.i) AS text, count(*) AS n
  FROM words ANTI JOIN gone ON gone.r = words.r AND gone.i = words.i GROUP BY words.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256, coalesce(n, 0) AS n_kept
FROM texts LEFT JOIN kept ON kept.r = texts.r"""


def periodic_runs(least: int, one_in: int) -> str:
    """Stretches of equal words at every distance, found among all pairs of a text's equal words."""
    return f"""WITH {_CRC_TABLE},
texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    {_crc32("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_table
),
aimed AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, h % {one_in} = 0 AND len(w) > 0 AS hit, h // {one_in} AS g,
    (h // {one_in}) % greatest(len(w), 1) AS a
  FROM texts
),
damaged AS (
  SELECT r, doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w
  FROM aimed
),
words AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM damaged),
equal AS (
  SELECT x.r, y.i - x.i AS p, x.i
  FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2
),
marked AS (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM equal),
stretches AS (SELECT r, p, min(i) AS s, count(*) + p AS l FROM marked GROUP BY r, p, island),
runs AS (
  SELECT r, s, l, min(p) AS p FROM stretches WHERE l >= greatest({least}, 2 * p) GROUP BY r, s, l
),
told AS (
  SELECT r, count(*) AS n_runs, max({{'l': l, 's': -s, 'p': -p}}) AS top,
    string_agg(concat_ws(',', s, l, p) || chr(10), '' ORDER BY s, p) AS lines
  FROM runs GROUP BY r
),
gone AS (SELECT DISTINCT r, unnest(range(s + p, s + l)) AS i FROM runs),
kept AS (
  SELECT words.r, string_agg(word, ' ' ORDER BY words.i) AS text
  FROM words ANTI JOIN gone ON gone.r = words.r AND gone.i = words.i GROUP BY words.r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(-top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length,
  CAST(-top.p AS BIGINT) AS period, CAST(1000 * top.l // -top.p AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM damaged LEFT JOIN told ON told.r = damaged.r LEFT JOIN kept ON kept.r = damaged.r"""
