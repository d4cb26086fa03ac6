"""Window hashes, and licence models that see all lines."""

import numpy as np
from pyspark.sql import functions as F

from rowsluice.llm import common as c
from rowsluice.llm.licenses import LicenseScanner


def test_window_hashes_tell_windows_apart():
    rng = np.random.default_rng(1)
    for k in (5, 8, 64, 100):
        data = np.concatenate((rng.integers(0, 2, 600), np.zeros(200, int), np.ones(200, int))).astype(np.uint8)
        data = np.concatenate((data, data[100:400]))
        windows = [data[i : i + k].tobytes() for i in range(len(data) - k + 1)]
        hashes = c.window_hash(data, k).tolist()
        assert len(hashes) == len(windows) and len(set(windows)) == len(set(hashes)) == len(set(zip(windows, hashes)))
    assert len(c.window_hash(data[:3], 8)) == 0
    bits = np.array([bin(i).count("1") % 2 for i in range(1 << 11)], np.uint8)  # Thue-Morse words and their complements
    a, b = c.window_hash(bits, 1024)[0], c.window_hash(1 - bits, 1024)[0]
    assert a != b


def test_licence_models_see_all_lines(spark):
    texts = [f"the river {i} ran to the sea\nnothing{i}" for i in range(300)] + ["licensed under the MIT license\n\nplain", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanner = LicenseScanner(max_unknown=10)
    rows, counts = scanner.vocabulary(spark)
    lines = scanner.lines(docs, counts.vocabulary)
    unknown = scanner.unknown(docs, lines)
    assert unknown.agg(F.sum("n")).first()[0] == 601  # all but the licence line
    found = {r["doc_id"]: r["family"] for r in scanner.scanned(docs).collect()}
    assert len(found) == 303 and found[300] == "mit" and {f for d, f in found.items() if d != 300} == {"unknown"}
