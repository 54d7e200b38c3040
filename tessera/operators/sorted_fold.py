"""Per-partition profile fold used by ``profile.fold_sorted`` (runs in Python workers).

Kept free of package imports and serialised *by value* (registered with
PySpark's cloudpickle), so executors run it without ``tessera`` installed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def fold_partition(prior: dict, names: tuple):
    """The ``mapInArrow`` function, with the prior and value names bound."""
    prior, names = dict(prior), tuple(names)

    def run(batches):
        return _fold(batches, prior, names)
    return run


def _step(state, v, t, own):
    """One update of a group of values (an array of ``state`` and of tag values ``v`` per
    value) for the users ``own``: the operations of ``fold_step`` in the same order, so the
    results are the same bit by bit."""
    held = [x[own] for x in state]
    d, s = held[0], v[0]
    for x, y in zip(held[1:], v[1:]):
        d, s = d + x, s + y
    d = d + s * t
    live = d != 0.0
    for x, h, y in zip(state, held, v):
        x[own] = np.where(live, (h + y * t) / np.where(live, d, 1.0), h)


def _fold(batches, prior, names):
    """Fold rows sorted by (mdn, rank, app_id), a batch at a time.

    rank 0 = start state (the stored profile), rank 1 = a step (``tagged`` false for an
    untagged app: skipped, the user is still emitted). A batch is cut into users; step k of
    all its users is one operation on arrays, so Python runs once per step of the user with
    most steps, not once per row. The last user's state is carried into the next batch:
    memory is one batch, whatever the number of rows of a user.
    """
    groups = (slice(0, 2), slice(2, len(names)))
    start = [float(prior[n]) for n in names]
    held_name, held = None, None            # the last user of the batches so far

    def emit(users, state):
        return pa.RecordBatch.from_arrays(
            [pa.array(users, pa.string())] + [pa.array(x, pa.float64()) for x in state],
            names=["mdn", *names])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = dict(zip(batch.schema.names, batch.columns))
        mdn = col["mdn"]
        first = np.empty(n, bool)
        first[0] = mdn[0].as_py() != held_name
        first[1:] = pc.not_equal(mdn.slice(1), mdn.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        user = np.cumsum(first) - first[0]                # 0 is the carried user, if any goes on
        users = mdn.take(pa.array(np.flatnonzero(np.diff(user, prepend=-1)))).to_pylist()
        if first[0] and held_name is not None:
            yield emit([held_name], [[x] for x in held])
        state = [np.full(len(users), x) for x in start]
        if not first[0]:
            for x, y in zip(state, held):
                x[0] = y
        # null values (of untagged apps) become NaN and are not used
        value = [col[c].to_numpy(zero_copy_only=False).astype(float) for c in names]
        rank = col["rank"].to_numpy(zero_copy_only=False)
        stored = np.flatnonzero(rank == 0)
        for x, v in zip(state, value):
            x[user[stored]] = v[stored]
        tagged = col["tagged"].to_numpy(zero_copy_only=False).astype(bool)
        rows = np.flatnonzero((rank != 0) & tagged)
        own = user[rows]
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        size = np.diff(np.append(begin, len(rows)))
        step = np.arange(len(rows)) - np.repeat(begin, size)
        by_step = rows[np.argsort(step, kind="stable")]
        times = col["times"].to_numpy(zero_copy_only=False).astype(float)
        cut = np.append(0, np.cumsum(np.bincount(step))) if len(rows) else [0]
        with np.errstate(all="ignore"):
            for a, b in zip(cut[:-1], cut[1:]):
                at = by_step[a:b]
                for g in groups:
                    _step(state[g], [v[at] for v in value[g]], times[at], user[at])
        held_name, held = users[-1], [x[-1] for x in state]
        if len(users) > 1:
            yield emit(users[:-1], [x[:-1] for x in state])
    if held_name is not None:
        yield emit([held_name], [[x] for x in held])


try:  # ship this module's code with the function instead of importing it remotely
    import sys as _sys

    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: the package must be importable
    pass
