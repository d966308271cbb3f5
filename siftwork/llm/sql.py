"""DuckDB SQL for the queries that SQL can express, written without the operators' methods."""

from __future__ import annotations

#: CRC-32 of a text by its table of 256 entries: ``crc_table(t)`` has them as a list.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_concat([i::UBIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i))"""


def _crc(text: str) -> str:
    """The unsigned CRC-32 of an expression, in a query over a table joined with ``crc_table``."""
    code = f"hex(encode({text}))"
    bytes_ = f"list_transform(range(1, length({code}) + 1, 2), lambda k: CAST('0x' || substr({code}, k, 2) AS UBIGINT))"
    return (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], {bytes_}), "
        "lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)"
    )


SPELLING = f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM
  (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, {_crc("doc_id || ':' || run")} AS h FROM runs, crc_table),
changed AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
  ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS MATERIALIZED (SELECT word, p, substr(word, 1, p::INT) || substr(word, p::INT + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS p FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word),
near AS (SELECT a AS word, count(*) AS n_near, min({{'n': -w.n, 'word': b}}) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a),
formed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 5 * n THEN best.word END AS form,
  CASE WHEN -best.n >= 5 * n THEN -best.n END AS form_n FROM words LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.onward)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.onward IS NULL"""


def _vector_codes(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """Rounds of a full search: every part meets every entry of its codebook."""
    steps = [
        """kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, q[p * (len(q) // {parts}) + 1:(p + 1) * (len(q) // {parts})] AS v
      FROM kept, range({parts}) AS r(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts QUALIFY e < {entries})""",
    ]
    gap = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT a.vec_id, a.label, a.p, a.v, min({{'d': {gap}, 'e': b.e}}) AS m
      FROM parts a JOIN book{r} b USING (p) GROUP BY a.vec_id, a.label, a.p, a.v)"""
        )
        if r < rounds:
            steps += [
                f"""sum{r} AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS c FROM
      (SELECT p, m.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{r}) GROUP BY p, e, i)""",
                f"""mean{r} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS v FROM sum{r} GROUP BY p, e)""",
                f"""book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.v, o.v) AS v FROM book{r} o LEFT JOIN mean{r} n USING (p, e))""",
            ]
    steps += [
        f"""coded AS MATERIALIZED (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
      FROM near{rounds} GROUP BY vec_id, label)""",
        f"""digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})""",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"""


VECTOR_CODES = _vector_codes()
