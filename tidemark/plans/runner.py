"""Jobs described by configuration: read, transform, write.

::

    {"input": [...], "transformation": [
        {"name": "join_df", "inputs": ["customers", "orders"],
         "params": {"join_cols": ["id"], "how": "inner"}, "output": "joined"}],
     "outputs": {"dataframe": "joined", "format": "parquet", ...}}

A step works on the frames it names in ``inputs``, by default on the result of
the step before. ``output`` names its result for later steps.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from ..sinks.writers import write_output
from ..sources.inputs import load_inputs
from .registry import Registry, registry

Frames = Mapping[str, DataFrame]

logger = logging.getLogger(__name__)


def read_config(config: Mapping[str, Any] | str | Path) -> dict[str, Any]:
    if isinstance(config, Mapping):
        return dict(config)
    return json.loads(Path(config).read_text(encoding="utf-8"))


def require(frames: Frames, names: Sequence[str]) -> list[DataFrame]:
    """The named frames, in order; a missing one is an error."""
    missing = [n for n in names if frames.get(n) is None]
    if missing:
        raise ValueError(f"Required input DataFrames are missing: {missing}")
    return [frames[n] for n in names]


def apply_steps(
    frames: Frames, steps: Sequence[Mapping[str, Any]], known: Registry = registry
) -> dict[str, DataFrame]:
    """All frames after the steps. The last result is also named ``result``."""
    frames = dict(frames)
    if len(frames) == 1:
        frames["result"] = next(iter(frames.values()))
    for step in steps:
        function = known.get(step["name"])
        given = require(frames, step.get("inputs") or ["result"])
        frames["result"] = function(*given, **(step.get("params") or {}))
        if step.get("output"):
            frames[step["output"]] = frames["result"]
    return frames


def run(
    spark: SparkSession,
    config: Mapping[str, Any] | str | Path,
    data_date: str | dt.date | None = None,
    transform: Callable[[Frames], DataFrame] | None = None,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """Run one job and return its result, which is also written if the
    configuration has an output.

    ``transform`` gets the frames by name and gives the result; without one the
    configured steps run. Cached inputs are released once the output is written.
    """
    conf = read_config(config)
    entries = conf.get("input") or []
    if isinstance(entries, Mapping):
        entries = [{"name": "input", **entries}]
    inputs = load_inputs(spark, entries)
    logger.info("Inputs: %s", ", ".join(inputs))
    output = conf.get("outputs") or conf.get("output")
    try:
        frames = apply_steps(inputs, conf.get("transformation") or [])
        if transform is not None:
            frames["result"] = transform(frames)
        name = "result" if transform is not None or not output else output.get("dataframe")
        (df,) = require(frames, [name or "result"])
        if output:
            write_output(spark, df, output, data_date, as_of)
    except BaseException:
        _release(inputs)
        raise
    if output:  # without one the caller has yet to use them
        _release(inputs)
    return df


def _release(inputs: Frames) -> None:
    for cached in inputs.values():
        if cached.is_cached:
            cached.unpersist()
