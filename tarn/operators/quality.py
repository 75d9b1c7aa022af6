"""Data-quality checks (declared on the variables dimension) and the
backfill-request validation, as single aggregate passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn import schemas as S


def check_dim_variables(dim: DataFrame, key: str = "id",
                        not_null=("id", "variable", "created_at", "agency", "callname"),
                        accepted: dict | None = None) -> DataFrame:
    """Q1-Q3: one row with the failing-row count of every check:
    ``<col>_nulls`` (not_null), ``<key>_duplicates`` (unique: keys that occur
    more than once), ``<col>_rejected`` (accepted_values; NULL passes)."""
    accepted = accepted if accepted is not None else {"agency": S.ACCEPTED_AGENCIES}
    checks = {f"{c}_nulls": F.col(c).isNull() for c in not_null}
    checks |= {f"{c}_rejected": F.col(c).isNotNull() & ~F.col(c).isin(*vals) for c, vals in accepted.items()}
    # One pass: counts per key, then their sums.
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(cond).alias(n) for n, cond in checks.items()])
    return per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", *checks)],
                       F.count_if(F.col("n_rows") > 1).alias(f"{key}_duplicates"))


def violations(rows: DataFrame, key: str = "id",
               not_null=("id", "variable", "created_at", "agency", "callname"),
               accepted: dict | None = None, stored_keys: DataFrame | None = None) -> DataFrame:
    """Q1-Q3 as rows: every row with ``reasons``, the list of the rules it
    breaks (empty: none): a column that is null, a value outside the accepted
    ones (NULL passes), a key that stands in several rows (each of them is
    reported) or that is among ``stored_keys`` (one row a key). A null key
    breaks not_null, never uniqueness. Repeated keys are counted before they
    are joined back, so a hot key ships one row per map task."""
    accepted = accepted if accepted is not None else {"agency": S.ACCEPTED_AGENCIES}
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in not_null]
    reasons += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*vals), F.lit(f"{c} not accepted")) for c, vals in accepted.items()]
    repeated = (rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__repeated")).agg(F.count(F.lit(1)).alias("__n"))
                .where("__n > 1").drop("__n"))
    out = rows.join(repeated, F.col(key) == F.col("__repeated"), "left")
    reasons.append(F.when(F.col("__repeated").isNotNull(), F.lit(f"{key} repeats")))
    if stored_keys is not None:
        out = out.join(stored_keys.select(F.col(key).alias("__stored")), F.col(key) == F.col("__stored"), "left")
        reasons.append(F.when(F.col("__stored").isNotNull(), F.lit(f"{key} is stored")))
    return out.select(*rows.columns, F.array_compact(F.array(*reasons)).alias("reasons"))


def failed_checks(checks: DataFrame) -> list[str]:
    """Names of the checks that failed; ``checks`` is their one-row result."""
    row = checks.first().asDict()
    return sorted(name for name, n in row.items() if name != "n_rows" and n)


def checked(mart: DataFrame, checks: DataFrame, strict: bool = False) -> tuple[DataFrame, list[str]]:
    """Run the declared checks after a mart is built; returns the mart
    with the failed checks, or raises when ``strict``."""
    failed = failed_checks(checks)
    if failed and strict:
        raise ValueError(f"quality checks failed: {failed}")
    return mart, failed


def validate_backfill(requests: DataFrame, max_days: int = S.BACKFILL_MAX_DAYS,
                      max_sites: int = S.BACKFILL_MAX_SITES,
                      max_params: int = S.BACKFILL_MAX_PARAMS) -> DataFrame:
    """Q4: accept a request iff every field is present and non-empty, the
    window is at most ``max_days`` days, at most ``max_sites`` sites and
    ``max_params`` parameters; otherwise list the reasons. A window that
    ends before it starts is rejected too (the reference accepts it)."""
    days = F.datediff("end_date", "start_date")
    present = (F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
               & (F.coalesce(F.size("params"), F.lit(0)) > 0)
               & (F.coalesce(F.size("sites"), F.lit(0)) > 0))
    reasons = F.array_compact(F.array(
        F.when(~present, F.lit("missing field")),
        F.when(present & (F.size("sites") > max_sites), F.lit(f"more than {max_sites} sites")),
        F.when(present & (F.size("params") > max_params), F.lit(f"more than {max_params} parameters")),
        F.when(present & (days > max_days), F.lit(f"more than {max_days} days")),
        F.when(present & (days < 0), F.lit("end before start")),
    ))
    return requests.select("*", days.alias("days"), (F.size(reasons) == 0).alias("accepted"),
                           reasons.alias("reasons"))
