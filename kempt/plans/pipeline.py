"""PL1: a pipeline is an ordered list of steps ``{"op": name, "params": {...}, "enabled": true}``
folded over a DataFrame with ``DataFrame.transform``.

Unlike the reference's flag-per-method classes, an unknown operator or a
missing / unexpected parameter raises before any data is touched, and a
failing step is never skipped silently.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from kempt.operators import cleanse, derive, privacy, relate, stats
from kempt.session import materialize

# Operators usable as pipeline steps: every one is (df, **params) -> DataFrame.
REGISTRY: dict[str, Callable[..., DataFrame]] = {
    "dedupe": cleanse.dedupe,
    "blank_to_null": cleanse.blank_to_null,
    "upper_strings": cleanse.upper_strings,
    "trim_strings": cleanse.trim_strings,
    "map_values": cleanse.map_values,
    "round_cols": cleanse.round_cols,
    "round_to_int": cleanse.round_to_int,
    "drop_incomplete": cleanse.drop_incomplete,
    "cast_cols": cleanse.cast_cols,
    "parse_dates": cleanse.parse_dates,
    "drop_cols": cleanse.drop_cols,
    "reencode": cleanse.reencode,
    "strip_special": cleanse.strip_special,
    "convert_unit": cleanse.convert_unit,
    "winsorize": stats.winsorize,
    "standardize": stats.standardize,
    "min_max": stats.min_max,
    "impute": stats.impute,
    "drop_sparse_nulls": stats.drop_sparse_nulls,
    "hash_cols": privacy.hash_cols,
    "redact": privacy.redact,
    "derive": derive.derive,
    "parse_address": derive.parse_address,
    "concat_cols": derive.concat_cols,
    "encode_map": derive.encode_map,
    "one_hot": derive.one_hot,
    "label_index": derive.label_index,
    "bin_col": derive.bin_col,
    "age_from_bracket": derive.age_from_bracket,
    "extract_pattern": derive.extract_pattern,
    "json_fields": derive.json_fields,
    "where": relate.where,
    "where_cmp": relate.where_cmp,
    "project": relate.project,
    "sort_by": relate.sort_by,
    "hash_sample": relate.hash_sample,
}


class PipelineError(ValueError):
    pass


def check_steps(steps: Sequence[Mapping], registry: Mapping[str, Callable] | None = None) -> list[tuple]:
    """Validate every step up front; returns (name, function, params) for enabled steps."""
    reg = registry or REGISTRY
    plan = []
    for i, step in enumerate(steps):
        name = step.get("op")
        if name not in reg:
            raise PipelineError(f"step {i}: unknown operator {name!r}")
        if not step.get("enabled", True):
            continue
        params = dict(step.get("params", {}))
        fn = reg[name]
        try:
            inspect.signature(fn).bind(None, **params)
        except TypeError as e:
            raise PipelineError(f"step {i} ({name}): {e}") from None
        plan.append((name, fn, params))
    return plan


# Steps that fit whole-table statistics: (aggregate expressions, values -> parameter, parameter name).
FITTERS: dict[str, tuple[Callable, Callable, str]] = {
    "winsorize": (lambda d, p: stats.moment_exprs(d, p["cols"]),
                  lambda v, d, p: stats.moments_from(v, d, p["cols"]), "stats"),
    "standardize": (lambda d, p: stats.moment_exprs(d, p["cols"]),
                    lambda v, d, p: stats.moments_from(v, d, p["cols"]), "stats"),
    "min_max": (lambda d, p: stats.moment_exprs(d, p["cols"]),
                lambda v, d, p: stats.moments_from(v, d, p["cols"]), "stats"),
    "drop_sparse_nulls": (lambda d, p: stats.null_share_exprs(d),
                          lambda v, d, p: stats.null_shares_from(v, d), "shares"),
    "impute": (lambda d, p: stats.impute_exprs(d, p["spec"]),
               lambda v, d, p: stats.impute_values_from(v, d, p["spec"]), "values"),
}
# Steps after which the plan contains a shuffle worth not repeating.
SHUFFLING = {"dedupe", "sort_by"}


def run_pipeline(df: DataFrame, steps: Sequence[Mapping] | str,
                 registry: Mapping[str, Callable] | None = None, materialize_fits: bool = True) -> DataFrame:
    """Fold the enabled steps over ``df`` (lazy, except where a step fits statistics).

    ``steps`` may be a JSON string holding the list.  With ``materialize_fits``, a
    fitting step that follows a shuffle (e.g. a de-duplication) does not make
    Spark compute the plan twice (once for the fit, once for the result): the
    frame is written once under the checkpoint folder and the step's statistics
    are computed during that write (``DataFrame.observe``).  Without a shuffle
    since the last write, the fit is a plain column-pruned aggregate."""
    if isinstance(steps, str):
        steps = json.loads(steps)
    out = df
    shuffled = False
    for name, fn, params in check_steps(steps, registry):
        if out.isStreaming and name in SHUFFLING:
            raise PipelineError(f"step {name!r} would keep state without limit on a stream; see streaming.ingest.dedupe_stream")
        fit = FITTERS.get(name) if registry is None or registry is REGISTRY else None
        exprs = fit[0](out, params) if fit is not None and materialize_fits and shuffled \
            and not out.isStreaming and params.get(fit[2]) is None else None
        if exprs:
            out, metrics = materialize(out, f"pipeline-{name}", observe=exprs)
            params = {**params, fit[2]: fit[1](metrics, out, params)}
            shuffled = False
        elif fit is not None and materialize_fits and shuffled and not out.isStreaming and params.get(fit[2]) is None:
            # a fit of several passes (exact median, mode): write once, then every pass reads the files
            out = materialize(out, f"pipeline-{name}")
            shuffled = False
        out = out.transform(lambda d, f=fn, p=params: f(d, **p))
        shuffled = shuffled or name in SHUFFLING
    return out
