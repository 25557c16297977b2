"""The pipeline against a plain version of each stage, and life without it."""

import re
import shutil
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
from test_contracts import brute_components, shingle_set

import corpus_pipeline
from broadsheet.llm.pieces import tokenizer
from broadsheet.llm.pii import luhn

ROOT = Path(corpus_pipeline.__file__).parent


def plain_redaction(text):
    """Base kinds only: on these tables the tagger adds nothing."""
    digits = lambda x: re.sub("[^0-9]", "", x)
    found = [(m.start(), 0, m.end(), "EMAIL") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end(), "IP") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if max(map(int, m[0].split("."))) <= 255]
    found += [(m.start(), 2, m.end(), "CARD") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end(), "PHONE") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= len(digits(m[0])) <= 15]
    out, at = "", 0
    for start, _, end, kind in sorted(found):
        if start >= at:
            out += text[at:start] + f"[{kind}]"
        at = max(at, end)
    return out + text[at:]


def test_stages_and_columns():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "decontaminate", "redact", "pack"]


def test_pipeline_equals_plain_stages(spark, given, sf_dir):
    plain = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {d: t for d, (t, *_) in given.items()}  # every language is recognised here
    roots = brute_components({d: shingle_set(t) for d, t in texts.items()})
    kept = {d: t for d, t in texts.items() if roots[d] == d}
    kept = {d: t for d, t in kept.items() if not any(i in plain(t) for i in items)}
    assert 0 < len(kept) < len(roots)
    encoder = tokenizer("byte_bpe_50k.json")
    expected = {d: encoder.encode(plain_redaction(t), add_special_tokens=False).ids + [1] for d, t in kept.items()}

    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    got = {d: np.frombuffer(b"".join(x[1] for x in sorted(own)), "<u4").tolist() for d, own in pieces.items()}
    assert got == expected


def test_other_queries_live_without_the_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, own, pipeline = done.stdout.split()
    assert int(count) > 60 and own == "0" and pipeline == "False"
