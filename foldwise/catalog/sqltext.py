"""SQL building blocks of the counterpart queries."""

from __future__ import annotations

from foldwise.catalog.bind import WITH_CASES


def r6(e, n=6):
    """Rounding that both engines agree on: decimal ties are moved off first."""
    return f"round(CAST({e} AS DOUBLE) + 1e-9, {n}) + 0.0"


def grid(bins):
    return "[" + ", ".join(f"{i}.0/{bins}" for i in range(bins + 1)) + "]"


def bin_sql(y, edges):
    return f"greatest(len(list_filter({edges}, lambda q: q < {y})) - 1, 0)"


def folds_ctes(src, tag="", bins=10, year="yr", splits=5, seeds=(42,), id_col="row_id", y="y"):
    """CTEs ending in ``folds{tag}``: all columns of ``src`` plus repeat and fold."""
    strata = f"bin{', ' + year if year else ''}"
    seed_rows = ", ".join(f"({i}, {s})" for i, s in enumerate(seeds))
    return f"""edges{tag} AS (SELECT list_distinct(quantile_cont({y}, {grid(bins)})) AS e FROM {src}),
  binned{tag} AS (SELECT s.*, {bin_sql(y, 'e')} AS bin FROM {src} s, edges{tag}),
  starts{tag} AS (SELECT {strata}, sum(count(*)) OVER (ORDER BY {strata}) - count(*) AS st FROM binned{tag} GROUP BY {strata}),
  ranked{tag} AS (SELECT b.*, v.repeat, row_number() OVER (PARTITION BY v.repeat, {strata}
      ORDER BY md5(concat(v.seed, ':', {id_col})), {id_col}) - 1 AS rk
    FROM binned{tag} b, (VALUES {seed_rows}) AS v(repeat, seed)),
  folds{tag} AS (SELECT r.* EXCLUDE (rk), CAST((rk + st) % {splits} AS INT) AS fold
    FROM ranked{tag} r JOIN starts{tag} USING ({strata}))"""


def inner_ctes(src, tag="", bins=20, splits=5, inner=4, seed=42, id_col="row_id", y="y"):
    """CTEs ending in ``nested{tag}``: ``src`` rows (with fold) x outer, plus inner."""
    return f"""outers{tag} AS (SELECT CAST(k AS INT) AS outer_k FROM range({splits}) AS t(k)),
  nedges{tag} AS (SELECT outer_k, list_distinct(quantile_cont({y}, {grid(bins)})) AS e
    FROM {src}, outers{tag} WHERE fold <> outer_k GROUP BY outer_k),
  nbins{tag} AS (SELECT s.*, o.outer_k, {bin_sql(y, 'e')} AS nbin
    FROM {src} s, outers{tag} o JOIN nedges{tag} USING (outer_k) WHERE s.fold <> o.outer_k),
  nstarts{tag} AS (SELECT outer_k, nbin, sum(count(*)) OVER (PARTITION BY outer_k ORDER BY nbin) - count(*) AS nst
    FROM nbins{tag} GROUP BY outer_k, nbin),
  nranked{tag} AS (SELECT *, row_number() OVER (PARTITION BY outer_k, nbin
    ORDER BY md5(concat({seed} + 31 * outer_k, ':', {id_col})), {id_col}) - 1 AS nrk FROM nbins{tag}),
  nested{tag} AS (SELECT r.* EXCLUDE (nbin, nrk), CAST((nrk + nst) % {inner} AS INT) AS inner_j
      FROM nranked{tag} r JOIN nstarts{tag} USING (outer_k, nbin)
    UNION ALL SELECT s.*, o.outer_k, -1 FROM {src} s, outers{tag} o WHERE s.fold = o.outer_k)"""


TRAIN_CASES = WITH_CASES + ", train AS (SELECT * FROM cases WHERE split = 'train')"

WEIGHT_CTES = """mix AS (SELECT yr, count(*) / (SELECT count(*) FROM train)::DOUBLE AS p FROM train GROUP BY yr),
  other AS (SELECT yr, count(*) / (SELECT count(*) FROM cases WHERE split = 'test')::DOUBLE AS q
    FROM cases WHERE split = 'test' GROUP BY yr),
  ratios AS (SELECT mix.yr, p, least(greatest(coalesce(q / p, 1.0), 0.25), 3.0) AS r
    FROM mix LEFT JOIN other ON mix.yr = other.yr),
  weights AS (SELECT row_id, r / (SELECT sum(p * r) FROM ratios) AS w
    FROM train JOIN ratios ON train.yr = ratios.yr)"""

MODELS = ("by_group", "by_year", "overall")
PRED_CTES = folds_ctes("train", seeds=(42, 2025)) + """,
  preds AS (
    SELECT row_id, repeat, fold, 'by_group' AS model, y,
      (sum(y) OVER (PARTITION BY repeat, grp) - sum(y) OVER (PARTITION BY repeat, grp, fold))
      / (count(*) OVER (PARTITION BY repeat, grp) - count(*) OVER (PARTITION BY repeat, grp, fold)) AS pred FROM folds
    UNION ALL SELECT row_id, repeat, fold, 'by_year', y,
      (sum(y) OVER (PARTITION BY repeat, yr) - sum(y) OVER (PARTITION BY repeat, yr, fold))
      / (count(*) OVER (PARTITION BY repeat, yr) - count(*) OVER (PARTITION BY repeat, yr, fold)) FROM folds
    UNION ALL SELECT row_id, repeat, fold, 'overall', y,
      (sum(y) OVER (PARTITION BY repeat) - sum(y) OVER (PARTITION BY repeat, fold))
      / (count(*) OVER (PARTITION BY repeat) - count(*) OVER (PARTITION BY repeat, fold)) FROM folds)"""
WITH_PREDS = f"{TRAIN_CASES}, {PRED_CTES}"
