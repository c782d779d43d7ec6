"""Detection over the history of a key: jumps, lasting rises, action patterns, control filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import scan
from tideline.operators.chain import greedy_chain
from tideline.session import stored

# fixed value: a key's value before its first row, the smallest positive double
SMALLEST_POSITIVE = 4.9e-324


def jumps(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, threshold: float,
    max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """(*key, *order, last, current) where a value is `threshold` or more away from the last."""
    seen = scan.running(
        df.select(*key, *order, value), key, order,
        [scan.previous("_last", F.col(value), order)], max_rows,
    )
    return seen.filter(F.abs(F.col(value) - F.col("_last.value")) >= threshold).select(
        *key, *order, F.col("_last.value").alias("last"), F.col(value).alias("current")
    )


def lasting_rises(
    df: DataFrame, key: Sequence[str], at: str, arrival: str, value: str, interval: int,
    max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """(*key, armed_at, alert_at): alerts for keys whose value did not fall for `interval`.

    `at` is a bigint event time. A rise arms an alert if none is armed, a strict fall up to the
    alert's time disarms it, an equal value does neither. After an alert the next rise arms again.
    A key starts from the smallest positive value, so its first positive row is a rise. Alerts
    that are armed when the input ends are given too. Rows without a key, a time or a value take no
    part.
    """
    known = df.select(*key, at, arrival, value).dropna(subset=[*key, at, value])
    rows = scan.cut(known, key, [at, arrival], max_rows)
    seen = rows.extend([scan.previous("_last", F.col(value), [at, arrival])])
    last = F.coalesce(F.col("_last.value"), F.lit(SMALLEST_POSITIVE))
    marked = seen.with_columns(
        {
            "_rise": F.col(value) > last,
            "_fall": (F.col("_last").isNotNull() & (F.col(value) < last)).cast("bigint"),
        }
    )
    runs = stored(
        marked.extend([scan.running_sum("_run", F.col("_fall"))])
        .rows.filter(F.col("_rise") | (F.col("_fall") == 1))
        .select(*key, "_run", at, "_rise", "_fall"),
        "runs",
    )
    rises = runs.filter("_rise").select(*key, "_run", at)
    armed = greedy_chain(rises, [*key, "_run"], at, interval, strict=True, max_rows=max_rows)
    ends = runs.filter("_fall = 1").select(
        *key, (F.col("_run") - 1).alias("_run"), F.col(at).alias("_ended")
    )
    alert_at = F.col(at) + interval
    return (
        armed.join(ends, [*key, "_run"], "left")
        .filter(F.col("_ended").isNull() | (F.col("_ended") > alert_at))
        .select(*key, F.col(at).alias("armed_at"), alert_at.alias("alert_at"))
    )


def _rules(rules: DataFrame, arrival: str) -> DataFrame:
    """One row per rule, from its first arrival on; a repeated rule replaces itself."""
    return rules.groupBy("action1", "action2").agg(F.min(arrival).alias("_known_from"))


def patterns(
    actions: DataFrame, rules: DataFrame, user: str, action: str, arrival: str,
    mode: str = "strict", max_rows: int = scan.MAX_ROWS,
) -> DataFrame:
    """(user, arrival, action1, action2) for every rule that an action completes.

    A rule applies to actions that arrive after it. `mode="strict"`: the user's previous action is
    action1 and the current one action2. `mode="reference"`: the current action is action2 and the
    user has any earlier action; action1 is not compared. Rows without a user or an action take no
    part in either mode. The joins are plain ones on the action: adaptive execution broadcasts the
    rules if they are small and splits frequent actions if not.
    """
    known = _rules(rules, arrival)
    done = actions.filter(F.col(user).isNotNull() & F.col(action).isNotNull()).select(
        user, action, arrival
    )
    later = F.col("_known_from") < F.col(arrival)
    completes = later & (F.col(action) == F.col("action2"))
    if mode == "strict":
        seen = scan.running(
            done, [user], [arrival], [scan.previous("_last", F.col(action), [arrival])], max_rows
        )
        found = seen.join(known, completes & (F.col("_last.value") == F.col("action1")))
    elif mode == "reference":
        first = done.groupBy(user).agg(F.min(arrival).alias("_first"))
        found = done.join(known, completes).join(first, user).filter(
            F.col("_first") < F.col(arrival)
        )
    else:
        raise ValueError(f"mode must be 'strict' or 'reference', not {mode!r}")
    return found.select(user, arrival, "action1", "action2")


def control_filter(
    words: DataFrame, control: DataFrame, word: str, arrival: str,
) -> DataFrame:
    """The words whose like has not arrived earlier on the control input."""
    blocked = control.groupBy(word).agg(F.min(arrival).alias("_blocked_from"))
    return (
        words.join(blocked, word, "left")
        .filter(F.col("_blocked_from").isNull() | (F.col("_blocked_from") >= F.col(arrival)))
        .select(*words.columns)
    )


def constant_filter(words: DataFrame, control: DataFrame, word: str, blocked: str) -> DataFrame:
    """Control rows pass as they are; words pass unless they equal `blocked`; nulls pass."""
    return control.select(word).unionByName(
        words.filter(~F.col(word).eqNullSafe(blocked)).select(word)
    )
