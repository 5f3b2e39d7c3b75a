"""op9: verdicts on all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import read
from .url_filters import STRONGEST, SUFFIXES, THRESHOLD, WEAKEST, Z, judge


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op9_url_filters": op9_url_filters}


def _prior(name: str, table: str) -> str:
    """mean and strength of a level's prior."""
    return f"""{name}_p AS (SELECT sum(r) / sum(n) AS p, count(*) AS g, sum(n) AS t, sum(1.0 / n) AS q FROM {table}),
{name}_v AS (SELECT any_value(p) AS p, any_value(g) AS g, any_value(q) AS q, any_value(g) * sum(n * (r / n - p) ** 2) / nullif((any_value(g) - 1) * any_value(t), 0) AS v FROM {table}, {name}_p),
{name}_k AS (SELECT coalesce(p, 0.5) AS p, CASE WHEN p IS NULL THEN {WEAKEST} WHEN g < 2 OR p IN (0, 1) OR v <= p * (1 - p) * q / g THEN {STRONGEST}
  ELSE least(greatest((p * (1 - p) - v) / (v - p * (1 - p) * q / g), {WEAKEST}), {STRONGEST}) END AS k FROM {name}_v)"""


ORACLE = {
    "op9_url_filters": rf"""WITH
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS a FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM hp JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
reached AS (SELECT DISTINCT host FROM hp JOIN rules ON host = h OR ends_with(host, '.' || h)),
name AS (SELECT host, regexp_replace(host, ':.*$', '') AS x, regexp_matches(regexp_replace(host, ':.*$', ''), '^[0-9.]+$') AS ip FROM (SELECT DISTINCT host FROM hp)),
lv AS (SELECT host, CASE WHEN ip THEN x WHEN regexp_extract(x, '([^.]*\.)?[^.]*$') IN {SUFFIXES} THEN regexp_extract(x, '([^.]*\.)?([^.]*\.)?[^.]*$') ELSE regexp_extract(x, '([^.]*\.)?[^.]*$') END AS domain,
  CASE WHEN ip THEN x WHEN regexp_extract(x, '([^.]*\.)?[^.]*$') IN {SUFFIXES} THEN regexp_extract(x, '([^.]*\.)?[^.]*$') ELSE regexp_extract(x, '[^.]*$') END AS suffix FROM name),
j AS (SELECT hp.*, rule, v, domain, suffix FROM hp LEFT JOIN fit USING (page_id) JOIN lv USING (host)),
h AS (SELECT host, domain, suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN v = 'block' THEN 1 ELSE 0 END) AS DOUBLE) AS r FROM j SEMI JOIN reached USING (host) GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(r) AS r, count(*) AS c, (sum(r / n) + 0.5) / (count(*) + 1) AS u FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n) AS n, sum(r) AS r, count(*) AS c, (sum(r / n) + 0.5) / (count(*) + 1) AS u FROM d GROUP BY suffix),
{_prior("s", "s")}, {_prior("d", "d")}, {_prior("h", "h")},
sm AS (SELECT suffix, (r + p * k) / (n + k) AS m, u, c + 1 AS t FROM s, s_k),
dm AS (SELECT domain, (r + m * k) / (n + k) AS m, d.u, d.c + 1 AS t FROM d JOIN sm USING (suffix), d_k),
hm AS (SELECT host, (r + m * k) / (n + k) AS m, n + k + 1 AS t FROM h JOIN dm USING (domain), h_k),
b AS (SELECT j.*, coalesce(hm.m - {Z} * sqrt(hm.m * (1 - hm.m) / hm.t), dm.u - {Z} * sqrt(dm.u * (1 - dm.u) / dm.t), sm.u - {Z} * sqrt(sm.u * (1 - sm.u) / sm.t)) AS bound
  FROM j LEFT JOIN hm USING (host) LEFT JOIN dm USING (domain) LEFT JOIN sm USING (suffix))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN bound > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict FROM b""",
}
