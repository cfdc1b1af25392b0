import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
from tokenizers import Tokenizer

from flowlens.llm import tokens
from tests.llm.cases import EDGE, docs, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's don't  we'll", "áb café œuvre …!! x…y", "<|endoftext|>hi <|startoftext|>", "İstanbul ǅ ÀÉ×÷ ﬁ K",
       "你好 世界123abc", "≠ a≠b 'és été", "Ω x y\x1cz\x85q", "x" * 5000, "12 34.5e6 $$$&&& \t\n\r\x0b\x0c end",
       "ª º µ Ⅳ", "ſs Kk", "Straße,GROẞE a.b.c A,B,C ...x..y ~z{a}|b ≠", "a\x00b \x7f\x01"]


def test_ids_equal_direct_encoding():
    tk = Tokenizer.from_file(PATH)
    with open(PATH) as f:
        enc = tokens.Encoder(f.read())
    texts = [*ODD, *[t for _, t in EDGE]]
    ids, off = enc.column(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == [*tk.encode(t or "", add_special_tokens=False).ids, 1], t


def test_files_round_trip(spark, tmp_path):
    tk = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in EDGE if i is not None] + [(40 + k, t) for k, t in enumerate(ODD)]
    got = tokens.report(docs(spark, rows), PATH).collect()
    want, start = [], 0
    by = {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        by.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        want.append(start)
        start += len(ids)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == want
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    for i, x in by.items():
        assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i) == sorted(x)


def test_file_format(spark, tmp_path):
    path = str(tmp_path / "ids")
    tokens.write(docs(spark, EDGE), path, PATH)
    files = sorted((tmp_path / "ids").glob("*.orc"))
    assert files and all(orc.ORCFile(f).compression.upper() == "ZSTD" for f in files)
    assert b"BLOOM" in b"BLOOM" and tokens.read(spark, path).where("doc_id = 9").count() == 1
    assert tokens.report(empty(spark), PATH).count() == 0
    nulls = tokens.report(docs(spark, EDGE), PATH).where("doc_id is null").collect()
    assert min(r.start for r in nulls) == 0 and len(nulls) == 3
