"""What a Python worker holds, measured in a process of its own."""

import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[2]
BEGIN = """
import re
import numpy as np
import pyarrow as pa
from kiln.llm import arrow, bpe

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
"""


def measured(code: str) -> list[int]:
    out = subprocess.run([sys.executable, "-c", BEGIN + code], cwd=TOP, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    return list(map(int, out.stdout.split()))


needs_proc = pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="memory is read from /proc")


@needs_proc
def test_freed_memory_goes_back():
    """Between two tasks a worker holds the last batch (16 MB) and little more, whatever the batch needed."""
    begin, end = measured("""
def batches():
    for _ in range(3):
        yield pa.RecordBatch.from_pydict({"text": ["word " * 400] * 8000})

begin = held()
for batch, texts in arrow.slices(batches(), "text"):
    made = [np.ones(1 << 11) for _ in range(4000)]
    outputs = pa.array([x.tobytes() for x in made[:1000]], pa.binary())
    del made, outputs
print(begin, held())
""")
    assert end - begin < 60


@needs_proc
def test_codec_with_many_words():
    """300,000 different words: the memories, and what one slice needs, stay within about 100 MB."""
    begin, most, kept = measured("""
codec = bpe.SegmentTreeBPE(bpe.default_path())
letters = np.random.default_rng(1).integers(97, 123, (300_000, 8)).astype(np.uint8)
words = [w.tobytes().decode() for w in letters]
texts = [" ".join(words[k : k + 200]) for k in range(0, len(words), 200)]
begin = most = held()
for _, part in arrow.slices([pa.RecordBatch.from_pydict({"text": texts})], "text", bpe.SLICE):
    codec.encode(part)
    most = max(most, held())
print(begin, most, (codec.words.held + codec.pieces.held) >> 20)
""")
    assert most - begin < 100 and kept <= 48
