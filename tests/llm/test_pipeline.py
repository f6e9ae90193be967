"""The corpus pipeline, stage by stage, against brute force, and as a whole."""

import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_llm import TOKENIZER, brute_languages, linked

from quirework.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"
corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stage = docs.columns, dict(corpus_pipeline.STAGES)
    given = {r.doc_id: r for r in docs.collect()}

    def run(name, before):
        out = stage[name](spark, before, SF)
        return corpus_pipeline.table(out, "tested", kept=True)

    one = run("language ID", docs)
    found = brute_languages([(r.text, r.lang, r.source, r.source, "") for r in given.values()])
    spoken = {i for i, (lang, sure) in zip(given, found, strict=True) if lang != "und" and sure >= 0.5}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == spoken and len(spoken) > 0.9 * len(given)

    two = run("SimHash near-dedup", one)
    ids = sorted(spoken)
    sets = [set(simhash.shingle_hashes((given[i].text or "").encode(), 5).tolist()) for i in ids]
    alike = [(a, b) for a in range(len(ids)) for b in range(a) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * max(1, len(sets[a] | sets[b]))]
    groups = linked(len(ids), alike)
    stays = {ids[g] for g in groups}
    assert two.columns == columns and {r.doc_id for r in two.collect()} == stays and len(stays) < len(ids)

    three = run("benchmark decontamination", two)
    items = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.text]
    windows = {(min(10, len(x)), tuple(x[k : k + 10])) for x in items for k in range(max(1, len(x) - 9)) if x}
    sizes, clean = {n for n, _ in windows}, {}
    for i in stays:
        words, hit = decontaminate.words_of((given[i].text or "").encode()), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if (n, tuple(words[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
        if len(hit) <= 0.5 * len(words):
            clean[i] = (words, hit)
    kept = {r.doc_id: r for r in three.collect()}
    assert three.columns == columns and set(kept) == set(clean)
    for i, (words, hit) in clean.items():
        assert kept[i].text == given[i].text if not hit else len(decontaminate.words_of(kept[i].text.encode())) <= len(words) - len(hit) + 10 * (len(hit) > 0)

    four = run("mixing sources", three)
    size = {i: len(re.findall(r"[^\x20\x09-\x0d]+", r.text or "")) for i, r in kept.items()}
    times = Counter(r.doc_id for r in four.collect())
    assert four.columns == columns and set(times) <= set(kept) and max(times.values()) <= 2
    own, taken, largest = Counter(), Counter(), Counter()
    for i, r in kept.items():
        own[r.source] += size[i]
        taken[r.source] += size[i] * times[i]
        largest[r.source] = max(largest[r.source], size[i])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(own))}
    full, left = set(), 1.5 * sum(own.values())
    while True:
        rest = sum(weight[s] for s in own if s not in full)
        target = {s: 2 * own[s] if s in full else (left - 2 * sum(own[x] for x in full)) * weight[s] / rest for s in own}
        more = {s for s in own if s not in full and target[s] > 2 * own[s]}
        if not more:
            break
        full |= more
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in own)

    five = stage["token output"](spark, four, SF).collect()
    tok = Tokenizer.from_file(TOKENIZER)
    assert Counter(r.doc_id for r in five) == times
    start = 0
    for r in sorted(five, key=lambda r: r.start):
        ids = [*tok.encode(kept[r.doc_id].text or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) > 100 and sorted(got) == sorted(corpus_pipeline.run(spark, SF).collect())
