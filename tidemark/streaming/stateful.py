"""Streams that keep keyed state: exact duplicates of a recent past, and transactions that span batches."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.transactions import RANK


def dedupe_recent(stream: DataFrame, keys: Sequence[str], payload: Sequence[str], window: str = "1 hour") -> DataFrame:
    """The stream without exact copies that arrive within ``window`` of the first one.

    State is one small row for each row that has arrived in that time, whatever the log holds. It goes
    by time of arrival, so no row is ever late and none is lost; copies that come later, and copies that
    differ, pass on to the ledger's index, which drops the first kind and fails on the second.
    """
    rows = stream.withColumn("_arrived", F.current_timestamp()).withColumn("_mark", F.sha2(F.to_json(F.struct(*payload)), 256))
    return rows.withWatermark("_arrived", window).dropDuplicatesWithinWatermark([*keys, "_mark"]).drop("_arrived", "_mark")


OBSERVATION = "transaction_id string, status string, offset bigint, event_count bigint, end_offset bigint, event_id string, recorded_at timestamp_ntz"
_LONGS = ("offset", "event_count", "end_offset")
_SEEN = ("status", "offset", "event_count", "end_offset", "event_id", "recorded_at")
#: JSON of transaction id to its best observation (_SEEN), begin_offset, and when it is quiet in ms: null once reported as stale.
_STATE = "held string"
#: Groups that transactions are dealt to by hash: a call and a state each, for a transaction alone is far too little work for either.
BUCKETS = 1 << 12
_OUT = "transaction_id string, status string, offset string, event_count string, end_offset string, event_id string, recorded_at string, begin_offset string, stale boolean"


def _order(o: tuple) -> tuple:
    """How effective_transactions ranks observations; a null sorts first."""
    status, offset, _, end, event, at = o[:6]
    known = lambda x: (x is not None, x or "")
    return (-1 if offset is None else int(offset), known(at), end is not None, RANK.get(status, 0), known(event))


def assemble_stream(observations: DataFrame, quiet: str = "1 hour", slack: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Effective states of transactions out of a stream of observations, whose BEGIN and END may come in any batch.

    A transaction's state is its greatest observation (the order of ``effective_transactions``) and the
    offset of its BEGIN. A row goes out whenever the state changes, so collapsing the output by that order
    gives the newest state, and copies or late observations change nothing. When nothing has come for
    ``quiet``, a complete transaction is forgotten and one that is not goes out again with ``stale``
    true, once, and stays: an END that comes still completes it. State thus grows with the transactions
    of a recent past and those that are open. Observations without an id pass as they are.

    Transactions share state and calls by hash, in ``buckets`` groups: a batch costs its own rows and the
    groups that it touches. The number belongs to the checkpoint, as the state's layout does.

    Timers go by time of arrival, so nothing is ever too late to count; ``slack`` is how far the clock
    may go back when the query moves to another machine.
    """
    span = int(pd.Timedelta(quiet).total_seconds() * 1000)
    rest = ("status", *_LONGS, "event_id", "recorded_at")
    rows = observations.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", slack)
    rows = rows.select("transaction_id", *(F.col(c).cast("string").alias(c) for c in rest), "_arrived", F.unix_millis("_arrived").alias("_ms"))
    rows = rows.withColumn("_key", F.pmod(F.xxhash64(F.coalesce("transaction_id", "event_id")), F.lit(buckets)).cast("int"))
    fields = [c.split(" ")[0] for c in _OUT.split(", ")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, out, before, arrived = state.getCurrentWatermarkMs(), [], {}, 0
        held = {name: (tuple(best), begin, due) for name, (best, begin, due) in json.loads(state.get[0]).items()} if state.exists else {}
        for batch in () if state.hasTimedOut else batches:
            arrived = max(arrived, int(batch["_ms"].max()))
            found = batch[["transaction_id", *_SEEN]].astype(object)
            for name, *o in found.where(found.notna(), None).itertuples(index=False, name=None):
                o = tuple(o)
                if name is None:
                    out.append((None, *o, None, False))
                    continue
                best, begin, due = held.get(name, (None, None, 0))
                before.setdefault(name, (best, begin))
                best = o if best is None or _order(o) > _order(best) else best
                if o[0] == "OPEN" and o[1] is not None and (begin is None or int(o[1]) < int(begin)):
                    begin = o[1]
                held[name] = best, begin, due
        for name, old in before.items():
            best, begin, due = held[name]
            if (best, begin) != old:
                out.append((name, *best, begin, False))
                due = 0
            held[name] = best, begin, due if due is None else max(arrived, now) + span
        for name in [n for n, (_, _, due) in held.items() if due is not None and due < now]:
            best, begin, _ = held.pop(name)
            if best[0] != "COMPLETE":
                held[name] = best, begin, None
                out.append((name, *best, begin, True))
        if held:
            state.update((json.dumps(held),))
            dues = [due for _, _, due in held.values() if due is not None]
            if dues:
                state.setTimeoutTimestamp(max(min(dues), now + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=fields)

    made = rows.groupBy("_key").applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return made.select("transaction_id", "status", *(F.col(c).cast("bigint").alias(c) for c in _LONGS), "event_id", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"), F.col("begin_offset").cast("bigint").alias("begin_offset"), "stale")
