"""Change data: SCD type 1 and 2, change feeds, state at a version, replicas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.clean import reject_null
from lakeops.operators.joins import key_match
from lakeops.operators.merge import (
    matched_delete,
    matched_update,
    merge_into,
    not_matched_insert,
)
from lakeops.operators.ordering import latest_per_key
from lakeops.operators.windows import ordered_features
from lakeops.session import settle

FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def _as_log(events: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str,
            except_cols: Sequence[str]) -> DataFrame:
    """Events as payload + ``__seq`` + ``__deleted``; NULL keys or sequences are an error."""
    payload = [c for c in events.columns if c not in except_cols]
    checked = reject_null(events, [*keys, sequence_by], "CDC event")
    return checked.select(*payload, F.col(sequence_by).alias("__seq"),
                          F.coalesce(F.expr(delete_when), F.lit(False)).alias("__deleted"))


def _with_state(log: DataFrame, state: DataFrame | None) -> DataFrame:
    return log if state is None else state.unionByName(log)


def _payload_hash(log: DataFrame, keys: Sequence[str]) -> Column:
    """A hash that tells (1, NULL) from (NULL, 1): hash functions pass over NULLs."""
    parts = [F.lit(0)]
    for name, kind in log.dtypes:
        if name not in (*keys, "__seq", "__deleted"):
            col = F.col(f"`{name}`")
            parts += [col.isNull(), F.to_json(F.struct(col)) if "map<" in kind else col]
    return F.xxhash64(*parts)


def _one_per(log: DataFrame, group: Sequence[str], order: Sequence[str],
             keys: Sequence[str]) -> DataFrame:
    """Latest row per group; at equal sequence a delete wins, then the payload hash decides."""
    tagged = log.withColumn("__hash", _payload_hash(log, keys))
    return latest_per_key(tagged, group, [*order, "-__deleted", "-__hash"]).drop("__hash")


def apply_scd1(events: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str,
               except_cols: Sequence[str] = (), state: DataFrame | None = None) -> DataFrame:
    """New SCD type 1 state: the latest row per key, tombstones included.

    Tombstones stay so that an older event that arrives late cannot bring a key back; read the
    state through :func:`scd1_rows`.
    """
    log = _with_state(_as_log(events, keys, sequence_by, delete_when, except_cols), state)
    return _one_per(log, keys, ["-__seq"], keys)


def scd1_rows(state: DataFrame) -> DataFrame:
    return state.where(~F.col("__deleted")).drop("__seq", "__deleted")


def scd2_log(events: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str,
             except_cols: Sequence[str] = (), state: DataFrame | None = None) -> DataFrame:
    """Accepted events, one per (key, sequence): the state from which history is derived."""
    log = _with_state(_as_log(events, keys, sequence_by, delete_when, except_cols), state)
    return _one_per(log, [*keys, "__seq"], [], keys)


def scd2_history(log: DataFrame, keys: Sequence[str], coalesce_noop: bool = False,
                 ranges: int | None = None) -> DataFrame:
    """Versions with ``__START_AT`` and ``__END_AT``; a delete only closes the open version.

    ``coalesce_noop`` drops an event whose payload equals the one before it. A key's events may lie
    in several ranges of the sequence (:func:`lakeops.operators.windows.ordered_features`).
    """
    payload = [c for c in log.columns if c not in ("__seq", "__deleted")]
    steps = settle(log, "scd2-events")  # read by each pass of the windows
    if coalesce_noop:
        rest = [c for c in payload if c not in keys]
        steps = steps.withColumn("__row", F.struct(F.col("__deleted"), *rest))
        steps = ordered_features(steps, keys, ["__seq"], {"__prev": ("lag", "__row")}, ranges)
        steps = settle(steps.where(~F.col("__row").eqNullSafe(F.col("__prev"))).drop("__row", "__prev"), "scd2-steps")
    steps = ordered_features(steps, keys, ["__seq"], {"__END_AT": ("lead", "__seq")}, ranges)
    return steps.where(~F.col("__deleted")).select(
        *payload, F.col("__seq").alias("__START_AT"), "__END_AT")


def apply_scd2(events: DataFrame, keys: Sequence[str], sequence_by: str, delete_when: str,
               except_cols: Sequence[str] = (), state: DataFrame | None = None,
               coalesce_noop: bool = False, ranges: int | None = None) -> DataFrame:
    """History after ``events`` on top of an earlier :func:`scd2_log`."""
    log = scd2_log(events, keys, sequence_by, delete_when, except_cols, state)
    return scd2_history(log, keys, coalesce_noop, ranges)


def refresh_scd2(history: DataFrame, log: DataFrame, events: DataFrame, keys: Sequence[str],
                 coalesce_noop: bool = False, ranges: int | None = None) -> DataFrame:
    """History after a batch, rebuilding only the keys the batch touches.

    ``log`` is the state that already contains ``events``; the history of all other keys is
    passed through.
    """
    touched = events.select(*keys).distinct()
    pairs = [(k, k) for k in keys]
    old = log.alias("t").join(touched.alias("s"), key_match(log, touched, pairs), "left_semi")
    kept = history.alias("t").join(
        touched.alias("s"), key_match(history, touched, pairs), "left_anti")
    return kept.unionByName(scd2_history(old, keys, coalesce_noop, ranges))


def current_rows(history: DataFrame) -> DataFrame:
    """The open version of every key."""
    return history.where(F.col("__END_AT").isNull())


def _side_by_side(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the old and the new payload as structs (NULL = absent).

    Union and group instead of a full outer join: equal keys combine in the map tasks, NULL keys
    meet each other, and a key that is not unique on one side is reported.
    """
    payload = [c for c in old.columns if c not in keys]
    rows = old.select(*keys, F.struct(*payload).alias("__old"),
                      F.lit(None).cast(old.select(F.struct(*payload)).schema[0].dataType)
                      .alias("__new"))
    news = new.select(*keys, F.lit(None).cast(rows.schema["__old"].dataType).alias("__old"),
                      F.struct(*[F.col(c).cast(old.schema[c].dataType).alias(c)
                                 for c in payload]).alias("__new"))
    sides = rows.unionByName(news).groupBy(*keys).agg(
        F.count("__old").alias("__n_old"), F.count("__new").alias("__n_new"),
        F.any_value("__old", F.lit(True)).alias("__old"),
        F.any_value("__new", F.lit(True)).alias("__new"))
    twice = (F.col("__n_old") > 1) | (F.col("__n_new") > 1)
    message = F.lit(f"key {', '.join(keys)} is not unique")
    return sides.where(F.when(twice, F.raise_error(message).cast("boolean"))
                       .otherwise(F.lit(True)))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int,
                commit_ts: Column | None = None) -> DataFrame:
    """Changes that lead from ``old`` to ``new``: insert, update pre- and post-image, delete."""
    payload = [c for c in old.columns if c not in keys]
    sides = _side_by_side(old, new, keys)
    same = F.col("__old").eqNullSafe(F.col("__new"))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    changes = (F.when(F.col("__n_old") == 0, F.array(change("insert", "__new")))
               .when(F.col("__n_new") == 0, F.array(change("delete", "__old")))
               .otherwise(F.array(change("update_preimage", "__old"),
                                  change("update_postimage", "__new"))))
    rows = sides.where(~same).select(*keys, F.explode(changes).alias("__c"))
    columns = [F.col(c) if c in keys else F.col(f"__c.row.{c}").alias(c) for c in old.columns]
    feed = rows.select(*columns, F.col("__c.kind").alias("_change_type"),
                       F.lit(version).cast("bigint").alias("_commit_version"))
    return feed if commit_ts is None else feed.withColumn("_commit_timestamp", commit_ts)


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ between two snapshots, NULL-safe, with the columns that changed."""
    payload = [c for c in old.columns if c not in keys]
    sides = _side_by_side(old, new, keys)
    status = (F.when(F.col("__n_old") == 0, "added").when(F.col("__n_new") == 0, "removed")
              .otherwise("changed"))
    names = F.array_compact(F.array(*[
        F.when(~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")), c) for c in payload]))
    return (sides.where(~F.col("__old").eqNullSafe(F.col("__new")))
            .select(*keys, status.alias("status"),
                    F.when(status == "changed", names).alias("changed_columns")))


def changes_between(feed: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """Commits ``low`` to ``high``, both included."""
    out = feed.where(F.col("_commit_version") >= low)
    return out if high is None else out.where(F.col("_commit_version") <= high)


def appended_only(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("_change_type") == "insert")


def latest_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change per key. Inside one commit the insert of a re-created key wins."""
    images = feed.where(F.col("_change_type") != "update_preimage")
    ranked = images.withColumn("__live", F.col("_change_type") != "delete")
    tie = [c for c in feed.columns if c not in (*keys, *FEED_COLUMNS)]
    ranked = ranked.withColumn("__hash", F.xxhash64(*tie) if tie else F.lit(0))
    return latest_per_key(ranked, keys, ["-_commit_version", "-__live", "-__hash"]).drop(
        "__live", "__hash")


def state_as_of(feed: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """The table as it was after commit ``version``."""
    last = latest_changes(changes_between(feed, 0, version), keys)
    meta = [c for c in FEED_COLUMNS if c in feed.columns]
    return last.where(F.col("_change_type") != "delete").drop(*meta)


def apply_change_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A replica after a batch of changes; the delete of an unknown key is ignored."""
    last = latest_changes(feed, keys)
    values = {c: f"s.`{c}`" for c in target.columns}
    return merge_into(target, last, keys, [
        matched_delete("s._change_type = 'delete'"),
        matched_update(values),
        not_matched_insert(values, "s._change_type != 'delete'"),
    ], null_safe=True)


def net_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key for a range of commits: what changed in the end, if anything.

    Decided from the first and last operation: insert then delete leaves nothing.
    """
    images = feed.where(F.col("_change_type") != "update_preimage")
    order = F.struct("_commit_version", (F.col("_change_type") != "delete").alias("live"))
    per_key = images.groupBy(*keys).agg(
        F.min_by("_change_type", order).alias("__first"),
        F.max_by("_change_type", order).alias("__last"))
    born = F.col("__first") == "insert"
    gone = F.col("__last") == "delete"
    net = (F.when(born & gone, None).when(born, "insert").when(gone, "delete")
           .otherwise("update"))
    return per_key.select(*keys, net.alias("net_change")).where("net_change IS NOT NULL")
