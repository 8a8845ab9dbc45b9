"""The pipeline against plain Python, and the entry point with and without the corpus part."""

import hashlib
import os
import re
import subprocess
import sys

import pyarrow.parquet as pq
from .test_decontamination import brute as benchmark_hits
from .test_near_copies import groups

import corpus_pipeline

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = "/root/testdata/sf0.001"


def cut(rows, length=200):
    data = {i: t.encode() for i, t, _ in rows}
    seen = {}
    for b in data.values():
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for i, _, source in rows:
        b, gone = data[i], bytearray(len(data[i]))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        out.append((i, bytes(x for x, g in zip(b, gone) if not g).decode(errors="ignore"), source))
    return out


def mixed(rows):
    """(doc_id, copy) -> words taken, with targets filled step by step."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    sources = sorted({s for *_, s in rows})
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    target, full = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        open_weight = sum(weight[s] for s in sources if s not in full)
        target = {s: 3 * total[s] if s in full else left * weight[s] / open_weight for s in sources}
        above = {s for s in sources if s not in full and target[s] > 3 * total[s]}
        if not above:
            break
        full |= above
    out = {}
    for s in sources:
        left = round(target[s])
        for copy in range(3):
            for i in sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
                take = min(size[i], left)
                left -= take
                if take:
                    out[i, copy] = take
    return out


def test_stages_equal_plain_python(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs if re.search(r"[^\W\d_]", r["text"] or "")]
    first = {i: head for i, _, head in groups([(i, t) for i, t, _ in rows], 5, 80)}
    rows = cut([r for r in rows if first[r[0]] == r[0]])
    rows = [r for r in rows if not benchmark_hits(r[1], items)[1]]
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["copy"]): r["take"] for r in got} == mixed(rows)
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)


def test_stages_return_the_columns_of_documents(spark, documents, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = documents.where("doc_id is not null")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == documents.columns and kept.dtypes == documents.dtypes, name
    assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() > 0
    none = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "mixing"]


def test_entry_point_works_without_the_corpus_part():
    script = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('hemline.llm', 'corpus_pipeline')): raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'mart_brand' in names and not any(n.startswith('op') or n == 'pipeline' for n in names), names\n"
        "assert set(e.oracle_sql()) == names\n")
    done = subprocess.run([sys.executable, "-c", script], cwd=HERE, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_every_operator_has_its_query():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
