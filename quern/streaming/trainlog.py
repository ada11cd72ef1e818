"""Training events as a stream: each training row gets the latest evaluation before it, and token counts per window of steps.

State per run: the last evaluation (loss, accuracy), counts of the window that is open, and the last step. Events of a run are taken in
order of (step, is_eval) within a batch; one that comes later than a step already passed is dropped and counted in ``late``. Evaluation batches
never count towards the training windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

EVENTS = "run string, step bigint, is_eval boolean, loss double, accuracy double, correct bigint, total bigint"
OUT = "run string, step bigint, loss double, last_eval_loss double, last_eval_accuracy double, window_accuracy double, late bigint"
_STATE = "eval_loss double, eval_accuracy double, correct bigint, total bigint, step bigint, late bigint"


def monitored(events: DataFrame, logging_steps: int = 1):
    """events: a stream with the columns of EVENTS. Rows with the columns of OUT; window_accuracy is set where a window closes."""
    import pandas as pd

    def advance(key, frames, state):
        eval_loss, eval_acc, correct, total, last, late = state.get if state.exists else (None, None, 0, 0, -1, 0)
        rows = []
        everything = pd.concat(list(frames)).sort_values(["step", "is_eval"])
        for e in everything.itertuples(index=False):
            if e.step < last:
                late += 1
                continue
            last = int(e.step)
            if e.is_eval:
                eval_loss = None if pd.isna(e.loss) else float(e.loss)
                eval_acc = None if pd.isna(e.accuracy) else float(e.accuracy)
                continue
            correct += 0 if pd.isna(e.correct) else int(e.correct)
            total += 0 if pd.isna(e.total) else int(e.total)
            closed = None
            if last % logging_steps == 0:
                closed = correct / total if total else 0.0
                correct = total = 0
            rows.append((key[0], last, e.loss, eval_loss, eval_acc, closed, late))
        state.update((eval_loss, eval_acc, correct, total, last, late))
        yield pd.DataFrame(rows, columns=["run", "step", "loss", "last_eval_loss", "last_eval_accuracy", "window_accuracy", "late"]).astype({"last_eval_loss": "float64", "last_eval_accuracy": "float64", "window_accuracy": "float64"})

    return events.groupBy("run").applyInPandasWithState(advance, OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
