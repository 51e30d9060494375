import gc
import re
import time
from pathlib import Path

import pytest

from lumenset.llm.common import release


def test_release_gives_memory_that_the_jvm_freed_back(spark):
    """Small buffers, every fortieth of which stays: without a trim the freed ones between them stay with the process."""
    jvm = spark.sparkContext._jvm
    status = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup")
    if not status.exists():
        pytest.skip("needs Linux")

    def held() -> float:
        return int(re.search(r"\nAnonymous:\s+(\d+)", status.read_text())[1]) / 1024

    made, stay = jvm.java.util.ArrayList(), jvm.java.util.ArrayList()
    for i in range(1600):
        (stay if i % 40 == 39 else made).add(jvm.java.nio.ByteBuffer.allocateDirect(64 << 10))
    del made
    for _ in range(2):  # buffers are freed by a thread of the JVM some time after its collection
        gc.collect()
        jvm.System.gc()
        time.sleep(1)
    before = held()
    release(spark)
    assert before - held() > 60
    del stay
