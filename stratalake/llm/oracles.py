"""DuckDB SQL of the operators that SQL can express."""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         greatest(0.05::DOUBLE, 1.0::DOUBLE - 20.0::DOUBLE
           * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')))::DOUBLE
           / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS w,
         ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s
), levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM ranked
), final AS (
  SELECT arg_min(level, cap::DOUBLE / weight) AS level FROM levels WHERE level * weight <= cap
), targets AS (
  SELECT r.source, r.source_size,
         CASE WHEN f.level IS NULL THEN r.cap::DOUBLE ELSE least(r.cap::DOUBLE, f.level * r.weight) END AS target
  FROM ranked r CROSS JOIN final f
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / w, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND epochs < 3 AND start + size / 2.0::DOUBLE <= target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


def _codes_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Product codes: the rounds written out one after the other."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS MATERIALIZED (
  SELECT x.rid, x.part, b.entry, sum((x.x - b.c) * (x.x - b.c))::BIGINT AS dist
  FROM x JOIN b{i} b ON x.part = b.part AND x.place = b.place GROUP BY ALL
), a{i} AS MATERIALIZED (
  SELECT rid, part, arg_min(entry, dist * 256::HUGEINT + entry) AS entry, min(dist) AS dist FROM d{i} GROUP BY ALL
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT a.part, x.place, a.entry, sum(x.x)::BIGINT AS s, count(*) AS n
  FROM x JOIN a{i} a ON x.rid = a.rid AND x.part = a.part GROUP BY ALL
), b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.place, b.entry, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.c) AS c
  FROM b{i} b LEFT JOIN m{i} m ON b.part = m.part AND b.place = m.place AND b.entry = m.entry
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), x AS MATERIALIZED (
  SELECT rid, d // (n // {parts}) AS part, d % (n // {parts}) AS place, x
  FROM (SELECT rid, len(v) AS n, unnest(v) AS x, unnest(range(len(v))) AS d FROM kept)
), b0 AS (
  SELECT part, place, rid - 1 AS entry, x AS c FROM x WHERE rid <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY rid
), books AS (
  SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds}
)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, books.codebooks_sha256
FROM kept k JOIN coded c ON k.rid = c.rid CROSS JOIN books
"""


OP12 = _codes_sql()


def _spelling_sql() -> str:
    """Spelling variants: a CRC-32 by half bytes, and all pairs of words of fitting lengths.

    ``levenshtein`` counts bytes, so each accented letter is first written as one byte.
    ``form_n`` is a long with nulls, which data frames hold as doubles.
    """
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(str(c))
    accented = "".join(chr(c) for c in range(0xC0, 0x100))
    plain = "".join(chr(c) for c in range(0x20, 0x7F) if not chr(c).islower() and chr(c) != "'")[: len(accented)]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{upper}', '{upper.lower()}') AS run, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z{accented[0]}-{accented[-1]}]{{6,}}')) AS run FROM documents)
  GROUP BY ALL
), hashed AS MATERIALIZED (
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(range(octet_length(encode(doc_id || ':' || run))),
             lambda i: [('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 2, 1))::BIGINT, ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 1))::BIGINT]))),
           lambda c, b: xor(c >> 4, ([{", ".join(table)}]::BIGINT[])[(xor(c, b) & 15) + 1]))) AS h
  FROM runs
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n, length(word) AS chars, translate(word, '{accented}', '{plain}') AS bytes
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), pairs AS MATERIALIZED (
  SELECT a.word AS a, a.n AS n_a, b.word AS b, b.n AS n_b FROM words a JOIN words b ON a.chars = b.chars AND a.word < b.word WHERE levenshtein(a.bytes, b.bytes) = 1
  UNION ALL
  SELECT a.word, a.n, b.word, b.n FROM words a JOIN words b ON a.chars + 1 = b.chars WHERE levenshtein(a.bytes, b.bytes) = 1
), near AS (
  SELECT a AS word, n_a AS n, b AS other, n_b AS m FROM pairs UNION ALL SELECT b, n_b, a, n_a FROM pairs
), best AS (
  SELECT word, n, count(*) AS n_near, max(m) AS m FROM near GROUP BY word, n
), forms AS MATERIALIZED (
  SELECT best.word, n_near, CASE WHEN best.m >= 5 * best.n THEN min(other) END AS form, CASE WHEN best.m >= 5 * best.n THEN best.m END AS form_n
  FROM best JOIN near ON best.word = near.word AND best.m = near.m GROUP BY best.word, best.n, n_near, best.m
), ways AS (
  SELECT word, form AS reached, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT ways.word, forms.form, step + 1 FROM ways JOIN forms ON ways.reached = forms.word WHERE forms.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(reached, step) AS root FROM ways GROUP BY word
)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n::DOUBLE AS form_n
FROM words w LEFT JOIN forms f ON w.word = f.word LEFT JOIN roots r ON w.word = r.word
"""


OP11 = _spelling_sql()
