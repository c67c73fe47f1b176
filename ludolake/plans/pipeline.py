"""The dependency graph of the three layers.

``raw`` → 12 flat tables + ``user_data`` → 10 dashboard metrics (+ the
disabled ``drop_rate3`` and the corrected revenue metric). A ``Sources``
callable maps an input name (a flat table name or ``"raw"``) to a DataFrame;
the same metric code runs on lazily derived flat DataFrames (queries, tests)
and on materialized flat tables (scheduled jobs).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.flatten import FLAT_SPECS, flatten, user_data

Sources = Callable[[str], DataFrame]

RAW = "raw"
USER_DATA = "user_data"
FLAT_TABLES = list(FLAT_SPECS) + [USER_DATA]


@dataclass(frozen=True)
class MetricSpec:
    name: str
    fn: Callable[..., DataFrame]
    inputs: list[str]
    # Inputs that may be restricted to days after a high-water mark without
    # changing the rows of those days. winrate2's first_open is not: its
    # user filter spans all days.
    scoped: list[str] = field(default_factory=list)
    incremental: bool = True
    # Days after its own that a day's rows need of an input.
    ahead: dict[str, int] = field(default_factory=dict)

    def build(self, sources: Sources, after=None, days: set[str] | None = None) -> DataFrame:
        """The metric; with ``after`` (a date), only the days after it; with
        ``days`` (ISO strings), only those."""
        args = []
        for name in self.inputs:
            df = sources(name)
            col = "date_par" if name == RAW else "event_date"
            if after is not None and name in self.scoped:
                df = df.filter(F.col(col) > F.lit(after))
            if days is not None and name in self.scoped:
                df = df.filter(_listed(col, days, self.ahead.get(name, 0)))
            args.append(df)
        return self.fn(*args)


def _listed(col: str, days: set[str], ahead: int):
    """Rows of the days and of the ``ahead`` days after each; what isn't a date
    stands for rows without a day."""
    known = {dt.date.fromisoformat(d) for d in days if d[:1].isdigit()}
    reach = sorted({d + dt.timedelta(days=k) for d in known for k in range(ahead + 1)})
    cond = F.col(col).isin(reach) if reach else F.lit(False)
    return cond | F.col(col).isNull() if len(known) < len(days) else cond


def _spec(name, fn, inputs, scoped=None, incremental=True, ahead=None):
    return MetricSpec(name, fn, inputs, list(inputs if scoped is None else scoped), incremental, ahead or {})


METRICS: dict[str, MetricSpec] = {s.name: s for s in [
    _spec("new_user", M.new_user, ["first_open"]),
    _spec("dau", M.dau, ["session_start"]),
    _spec("playtime", M.playtime, [RAW]),
    # Sessions and user_data rows of a cohort are on or after its cohort day,
    # so all three inputs may be cut at the mark.
    _spec("cohort", M.cohort, ["first_open", "session_start", USER_DATA],
          ahead={"session_start": M.COHORT_MAX_DAY}),
    _spec("rev_iap_ads3", M.rev_iap_ads3, ["user_engagement", "ad_impression", "in_app_purchase"]),
    _spec("rev_iap_ads3_corrected",
          lambda e, a, i: M.rev_iap_ads3(e, a, i, corrected=True),
          ["user_engagement", "ad_impression", "in_app_purchase"]),
    _spec("winrate2", M.winrate2, ["start_level", "win_level", "lose_level", "first_open"],
          scoped=["start_level", "win_level", "lose_level"]),
    _spec("level_booster2", M.level_booster2, ["start_level", "booster_used"]),
    _spec("booster_type", M.booster_type, ["booster_used"]),
    _spec("ads_inter_rw_cnt", M.ads_inter_rw_cnt, ["user_engagement", "ad_impression"]),
    _spec("drop_final", M.drop_final, ["start_level"]),
    _spec("drop_rate3", M.drop_rate3, ["start_level"], incremental=False),
]}

# The column layout (and cluster keys) of each metric's table: the corrected
# revenue metric has the same columns as rev_iap_ads3.
METRIC_SHAPE = {name: name if name in M.METRIC_COLUMNS else "rev_iap_ads3"
                for name in METRICS}


def derived_sources(raw: DataFrame, strict: bool = True) -> Sources:
    """Sources computed lazily from a raw DataFrame."""
    def get(name: str) -> DataFrame:
        if name == RAW:
            return raw
        if name == USER_DATA:
            return user_data(raw)
        return flatten(raw, name, strict=strict)
    return get
