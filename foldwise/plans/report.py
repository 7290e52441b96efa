"""The profiling report: every section a table, in the order it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from foldwise import fixed
from foldwise.operators import features, folds, profile, study
from foldwise.operators.drift import drift_auc
from foldwise.operators.textlearn import text_signal
from foldwise.scratch import written
from foldwise.spec import BUDGETS, Budget, TableSpec


def report(spec: TableSpec, train: DataFrame, test: DataFrame, budget: Budget | str = "fast",
           text: bool = True) -> dict[str, DataFrame]:
    budget = BUDGETS[budget] if isinstance(budget, str) else budget
    train, test = written(train), written(test)
    names = features.numeric_columns(train, (spec.id, spec.target))
    params = {"rounds": budget.trees, "depth": budget.depth}
    out = {
        "target": profile.target_profile(train, spec.target),
        "target_histogram": profile.histogram(train, spec.target, 60),
        "null_rates": profile.null_rates(train),
        "informative_nulls": profile.informative_nulls(train, list(spec.null_cols), spec.target),
        "correlations": profile.correlations(train, names, spec.target),
        "importance": study.permutation_ranking(train, spec.id, spec.target, names, params=params,
                                                repeats=budget.permutations),
    }
    if spec.year:
        out["target_by_year"] = profile.target_by(train, spec.target, spec.year)
    if spec.text and text:
        r2, terms = text_signal(train, spec.id, spec.text, spec.target, budget.folds,
                                fixed.PROFILE_TERMS, rounds=min(100, 5 * budget.trees))
        out["text_lengths"] = profile.text_lengths(train, spec.text)
        out["text_terms"] = terms
        out["text_r2"] = train.sparkSession.createDataFrame([(r2,)], "oof_r2 double")
    if spec.year:
        out["year_mix"] = folds.year_mix(train, test, spec.year)
    out["drift_auc"] = drift_auc(train, test, spec.id, names, budget.folds, budget.trees, budget.depth)
    return out
