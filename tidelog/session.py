"""Session settings by input size. The jobs themselves change no setting."""

from __future__ import annotations

import math

# Bytes per scan task, and per shuffle partition before adaptive execution joins
# small ones and splits skewed ones. A quarter of a gigabyte of compressed rows is
# sorted in the memory of a core, and keeps 100 TB at about 400,000 partitions.
SCAN_BYTES = 256 * 1024 * 1024
SHUFFLE_BYTES = 256 * 1024 * 1024
# A join whose partitions all turn out smaller than this is hashed instead of sorted.
HASH_BYTES = 64 * 1024 * 1024


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that shuffles about as much as it reads.

    Adaptive execution merges partitions that turn out small.
    """
    partitions = max(cores, math.ceil(input_bytes / SHUFFLE_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(HASH_BYTES),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(HASH_BYTES),
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
    }
