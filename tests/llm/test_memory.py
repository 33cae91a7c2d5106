"""What steps leave behind in the driver's JVM."""

import gc
import re
import time
from pathlib import Path

from lastword.llm import frames


def held(jvm):
    """MB of the driver's JVM that no file backs."""
    pid = jvm.java.io.File("/proc/self").getCanonicalFile().getName()
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024


def test_release_returns_memory_outside_the_heap(spark):
    jvm = spark.sparkContext._jvm
    buffers = [jvm.java.nio.ByteBuffer.allocateDirect(1 << 16) for _ in range(4000)]
    full = held(jvm)
    buffers = buffers[::200]  # what stays lies between what goes, so that free() alone returns little
    gc.collect()
    for _ in range(4):
        jvm.System.gc()
        time.sleep(0.5)
    freed = held(jvm)
    frames.release(spark)
    assert held(jvm) < freed - 150, (full, freed)
    assert len(buffers) == 20
