"""DuckDB SQL of operators 11 to 13."""

from __future__ import annotations

import re

from incidentflow.llm.license_scan import BASE, TEMPLATES, strength

_WORDS = r"regexp_extract_all(regexp_replace_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """The words of a text column, A-Z lower-cased."""
    return _WORDS.replace("regexp_replace_az", f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')")


#: The five conditions of every document, counted by part and failure set; the
#: 120 orders; every step's set of filters before it.
OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
masks AS (
  SELECT part, doc_id IN (FROM good) AS g, doc_id IN (FROM toxic) AS x,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM w),
states AS (SELECT part, mask, count(*) AS n, count(*) FILTER (g) AS good, count(*) FILTER (x) AS toxic FROM masks GROUP BY part, mask),
letters AS (SELECT chr(65 + i::INT) AS l, (1 << i)::INT AS bit FROM range(5) r(i)),
grown AS (
  SELECT l AS o, bit AS used, 1 AS k FROM letters
  UNION ALL
  SELECT o || l, used + bit, k + 1 FROM grown JOIN letters ON used & bit = 0 WHERE k < 5),
steps AS (
  SELECT o AS filter_order, s::INT AS step, l, bit, coalesce((SELECT sum(b.bit) FROM letters b WHERE contains(substr(o, 1, s::INT - 1), b.l)), 0)::INT AS before
  FROM grown CROSS JOIN range(1, 6) r(s) JOIN letters ON l = substr(o, s::INT, 1) WHERE k = 5),
counted AS (
  SELECT part, filter_order, step, l,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM states CROSS JOIN steps GROUP BY ALL)
SELECT * EXCLUDE (l), (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM counted
"""


def as_regex(template: str) -> str:
    """The template over a text of words with one space before each."""
    out = []
    for token in re.findall(r"\[\[|\]\]|<<[^<>]*>>|[^\s\[\]<>]+", template):
        if token == "[[":
            out.append("(?:")
        elif token == "]]":
            out.append(")?")
        elif span := re.fullmatch(r"<<(\d+)-(\d+)>>", token):
            out.append(f"(?: [^ ]+){{{span[1]},{span[2]}}}")
        elif token.startswith("<<"):
            out.append("(?:" + "|".join("".join(f" {w}" for w in x.split()) for x in token[2:-2].split("|")) + ")")
        else:
            out.append(f" {token}")
    return "".join(out)


def mandatory(template: str) -> int:
    """Mandatory words: what is left without optional and counted regions."""
    while "[[" in template:
        template = re.sub(r"\[\[[^\[\]]*\]\]", " ", template)
    return len(re.sub(r"<<[^<>]*>>", " x ", re.sub(r"<<\d+-\d+>>", " ", template)).split())


def op12_sql() -> str:
    every = [*BASE, *TEMPLATES]
    hits = ",\n    ".join(
        f"CASE WHEN regexp_matches(joined, '{as_regex(t)} ') THEN {{'label': '{label}', 'score': {strength(mandatory(t))!r}::DOUBLE, 'base': {k < len(BASE)}}} END"
        for k, (label, t) in enumerate(every)
    )
    longest = max(len(t.split()) for _, t in BASE)
    starts = " OR ".join(f"run[1:{len(t.split())}] = {t.split()}" for _, t in BASE)
    return f"""
WITH w AS (SELECT doc_id, {words('text')} AS w FROM documents),
hits AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS joined,
  [x FOR x IN [{hits}] IF x IS NOT NULL] AS h FROM w),
places AS (
  SELECT doc_id, w, h, [i FOR i IN range(len(w)) IF (w[i + 1] IN {tuple(sorted({t.split()[0] for _, t in BASE}))!r}) AND ({starts.replace("run[1:", "w[i + 1:i + ")})] AS p FROM hits)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, p[1]::BIGINT AS first_word, p[-1]::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct([x.label FOR x IN h IF x.base])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([x.label FOR x IN h])), ',') AS labels,
  coalesce(list_max([x.score FOR x IN h]), 0.0)::DOUBLE AS score
FROM places
"""


#: The checksum table, every distinct run's checksum byte by byte, then the draw.
OP13_SQL = f"""
WITH tab AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
words AS (
  SELECT 0 AS side, doc_id, {words('text')} AS w FROM documents
  UNION ALL SELECT 1, item_id, {words('text')} FROM benchmark),
numbered AS (SELECT *, row_number() OVER () AS row FROM words),
runs AS (
  SELECT row, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM numbered),
bytes AS (
  SELECT f, [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(len(h) // 2)] AS b FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs))),
buckets AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM bytes, tab),
found AS (SELECT row, side, doc_id, bucket FROM runs JOIN buckets USING (f) JOIN numbered USING (row)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM found GROUP BY bucket),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((c.t + 1)::DOUBLE * (o.s + 10000) / ((c.s + 1)::DOUBLE * (o.t + 10000))))::BIGINT AS gain FROM counts c, totals o),
weights AS (SELECT row, count(*) AS n, sum(gain) AS total FROM found JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (
  SELECT doc_id, len(w) >= 20 AS eligible, coalesce(n, 0) AS n_features, coalesce(floor(total / n), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
  FROM numbered LEFT JOIN weights USING (row) WHERE side = 0),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS r, count(*) FILTER (eligible) OVER () AS n_eligible FROM final)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN eligible AND r <= 25 * n_eligible // 100 THEN r END AS rank FROM ranked
"""
