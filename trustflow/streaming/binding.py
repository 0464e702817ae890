"""A registry of checkpoints: who may go on with which.

A registry is a folder with one entry per checkpoint, named by the hash of its location and never
changed. An entry says which stream owns the checkpoint and what it reads, writes and applies.
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from trustflow.sources import store

ENTRY_FORMAT = 1


@dataclass(frozen=True)
class Claim:
    owner: str
    source: str
    target: str
    rules: str = ""


def _entry(registry: str, checkpoint: str) -> str:
    return f"{registry.rstrip('/')}/{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()}.json"


def claim(spark: SparkSession, registry: str, checkpoint: str, wanted: Claim) -> bool:
    """True for a checkpoint that is claimed now, False for one that this claim has already.

    Refused are a checkpoint of another claim (the message names what differs), an entry of a later
    format, and offsets that were written before anyone had claimed the checkpoint.
    """
    place = _entry(registry, checkpoint)
    if store.exists(spark, place):
        entry = store.read_json(spark, place)
        if entry.pop("format") > ENTRY_FORMAT:
            raise ValueError(f"{checkpoint} was claimed by a later version")
        entry.pop("checkpoint")
        other = [f"{k} {entry.get(k)!r} is not {v!r}" for k, v in asdict(wanted).items() if entry.get(k) != v]
        if other:
            raise ValueError(f"{checkpoint} has another claim: {'; '.join(other)}")
        return False
    if store.exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{checkpoint} holds offsets that nobody claimed")
    # Exclusive: of two streams that start at once, one fails here.
    store.create_json(spark, place, {"format": ENTRY_FORMAT, "checkpoint": checkpoint, **asdict(wanted)})
    return True
