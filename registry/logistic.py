"""SQL twins of the logistic regressions: the optimum is unique, so another engine finds the same one.

The features are put into long form (row, place in the vector, value), zeros left out. One recursive table holds the
coefficients; a step adds up gradient and curvature and solves its equations by elimination over lists.
"""

from __future__ import annotations

#: Newton steps. The later ones change nothing but the last digits.
STEPS = 20

#: Digits of coefficients and probabilities that are compared.
DIGITS = 6

_FIT = """,
split AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY label, key) AS row_id FROM (
    SELECT * EXCLUDE ({id}), {id} AS key,
           row_number() OVER (PARTITION BY label ORDER BY md5({id} || ':42'), {id})
             <= floor(0.25 * count(*) OVER (PARTITION BY label) + 0.5) AS test
    FROM ({features}) WHERE label IS NOT NULL)),
numbers AS (
  SELECT row_id, test, unnest([{number_names}]) AS feature, unnest([{number_values}]) AS value FROM split),
scales AS (
  SELECT feature, mean, sqrt(sum((coalesce(value, mean) - mean) ** 2) / count(*)) AS deviation
  FROM numbers JOIN (SELECT feature, avg(value) AS mean FROM numbers WHERE NOT test GROUP BY feature) USING (feature)
  WHERE NOT test GROUP BY feature, mean),
levels AS (
  SELECT row_id, test, unnest([{level_names}]) AS feature, unnest([{level_values}]) AS level FROM split),
entries AS MATERIALIZED (
  SELECT row_id, test, feature,
         if(deviation > 0, (coalesce(value, mean) - mean) / deviation, 0) AS value
  FROM numbers JOIN scales USING (feature)
  UNION ALL SELECT row_id, test, feature || '_' || level, 1 FROM levels
  UNION ALL SELECT row_id, test, NULL, 1 FROM split),
names AS MATERIALIZED (
  SELECT feature, row_number() OVER (ORDER BY feature NULLS LAST) AS j
  FROM (SELECT DISTINCT feature FROM entries WHERE NOT test)),
x AS MATERIALIZED (
  SELECT row_id, test, j, value FROM entries JOIN names ON entries.feature IS NOT DISTINCT FROM names.feature),
train AS MATERIALIZED (
  SELECT row_id, label, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)) AS weight
  FROM split WHERE NOT test),
pairs AS MATERIALIZED (
  SELECT a.row_id, a.j AS j, b.j AS k, a.value * b.value AS product
  FROM x a JOIN x b USING (row_id) WHERE NOT a.test),
fitted AS (
  SELECT 0 AS step, (SELECT list(0::DOUBLE ORDER BY j) FROM names) AS beta
  UNION ALL
  SELECT step + 1, (
    WITH margins AS (
      SELECT row_id, 1 / (1 + exp(-sum(value * beta[j]))) AS p FROM x WHERE NOT test GROUP BY row_id),
    slopes AS (
      SELECT row_id, weight * (label - p) AS slope, weight * p * (1 - p) AS bend FROM margins JOIN train USING (row_id)),
    gradient AS (
      SELECT j, sum(slope * value) - if(feature IS NULL, 0, beta[j]) AS g
      FROM slopes JOIN x USING (row_id) JOIN names USING (j) GROUP BY j, feature),
    curved AS (
      SELECT j, k, sum(bend * product) AS h FROM pairs JOIN slopes USING (row_id) GROUP BY j, k),
    full_rows AS (
      SELECT a.j, list(coalesce(h, 0) + if(a.j = b.j AND a.feature IS NOT NULL, 1, 0) ORDER BY b.j) AS line
      FROM names a CROSS JOIN names b LEFT JOIN curved ON curved.j = a.j AND curved.k = b.j GROUP BY a.j),
    equations AS (SELECT list(list_append(line, g) ORDER BY j) AS lines FROM full_rows JOIN gradient USING (j)),
    solved AS (
      SELECT list_reduce(
        list_prepend(lines, list_transform(range(1, len(lines) + 1), lambda s: [[s::DOUBLE]])),
        lambda m, e: list_transform(m, lambda r, i:
          if(i = e[1][1], list_transform(r, lambda v: v / r[e[1][1]::INT]),
             list_transform(list_zip(r, m[e[1][1]::INT]),
               lambda z: z[1] - r[e[1][1]::INT] * z[2] / m[e[1][1]::INT][e[1][1]::INT])))) AS lines
      FROM equations)
    SELECT list_transform(lines, lambda r, i: beta[i] + r[-1]) FROM solved)
  FROM fitted WHERE step < {steps}),
coefs AS MATERIALIZED (
  SELECT feature, j, (SELECT beta[j] FROM fitted WHERE step = {steps}) AS coefficient FROM names),
tested AS (
  SELECT key AS {id}, label, 1 / (1 + exp(-sum(value * coefficient))) AS probability
  FROM split JOIN x USING (row_id) JOIN coefs USING (j) WHERE split.test GROUP BY key, label),
guessed AS (SELECT *, (probability > 0.5)::INT AS prediction FROM tested)
"""

_RESULTS = {
    "coefs": """SELECT feature, round(coefficient, {digits}) AS coefficient FROM coefs
      WHERE feature IS NOT NULL ORDER BY abs(coefficient) DESC, feature LIMIT 12""",
    "scores": """SELECT {id}, label, round(probability, {digits}) AS probability, prediction FROM guessed""",
    "logreg": """SELECT 'logistic regression' AS model,
        round((places - ones * (ones + 1) / 2) / (ones * (rows_n - ones)), 3) AS auc,
        round(hits / rows_n, 3) AS accuracy, round(coalesce(found / nullif(called, 0), 0), 3) AS "precision",
        round(found / ones, 3) AS recall, rows_n
      FROM (SELECT count(*) AS rows_n, count(*) FILTER (label = prediction) AS hits,
              count(*) FILTER (label = 1 AND prediction = 1) AS found, count(*) FILTER (prediction = 1) AS called,
              count(*) FILTER (label = 1) AS ones, sum(place) FILTER (label = 1) AS places
            FROM (SELECT *, rank() OVER (ORDER BY probability)
                    + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS place FROM guessed))""",
}


def twins(prefix: str, model: str, features: str, id_column: str, numbers: list[str], listed: list[str]) -> dict[str, str]:
    """SQL by key for the three queries of a model, ``prefix`` being the shared tables they start from."""
    fields = {
        "id": id_column,
        "features": features,
        "number_names": ", ".join(f"'{n}'" for n in numbers),
        "number_values": ", ".join(f"{n}::DOUBLE" for n in numbers),
        "level_names": ", ".join(f"'{n}'" for n in listed),
        "level_values": ", ".join(f"coalesce({n}, '(missing)')" for n in listed),
        "steps": STEPS,
        "digits": DIGITS,
    }
    start = prefix.replace("WITH ", "WITH RECURSIVE ", 1) + _FIT.format(**fields)
    return {f"{model}_{kind}": start + body.format(**fields) for kind, body in _RESULTS.items()}
