"""WARC and token files, and the whole pipeline."""
import gzip
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np

from monthcast.llm import lang_id, queries, token_output, warc

from .conftest import SF


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def brute_records(pages, least=1000):
    groups = defaultdict(list)
    for i, html in pages:
        p = (html or "").encode()
        groups[p].append(i)
    out = []
    for p, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            older = len(p) >= least and top is not None and (i is None or i < top)
            out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if older else "response", top if older else None))
    return sorted(out, key=str)


def files_of(root):
    return {f: open(os.path.join(root, f), "rb").read() for f in sorted(os.listdir(root))}


def test_warc(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = brute_records([(r.page_id, r.html) for r in pages.collect()])
    assert sorted(rows_of(queries.op2_warc(spark, "/root/testdata/sf0.01")), key=str) == want
    big, odd = "<p>é" * 400, "x" * 999
    rows = [(i, f"http://h/{i}\r\nEvil: 1", big if i % 3 == 0 else f"{i}" * 400, 1) for i in range(40)]
    rows += [(50, "u", odd, 1), (51, "u", odd, 1), (39, None, None, None), (60, "", "", 0), (60, "", "", 0), (39, "again", big, 2), (None, "n", big, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, shard int").repartition(3)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    manifest = warc.write_warc(pages, a, min_shards=5, roll_bytes=600)
    assert sorted(rows_of(warc.read_warc(manifest, a)), key=str) == brute_records([(r[0], r[2]) for r in rows])
    again = warc.write_warc(pages.repartition(7), b, min_shards=5, roll_bytes=600)
    assert files_of(a) == files_of(b) and len(files_of(a)) > 8
    listed = {r.file: r for r in manifest.collect()}
    for name, data in files_of(a).items():
        assert (listed[name].bytes, listed[name].sha256) == (len(data), hashlib.sha256(data).hexdigest())
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Record-ID") == listed[name].records
        assert b"\nEvil: 1" not in text
    assert sorted(rows_of(manifest)) == sorted(rows_of(again))
    firsts = [r.first_id for r in sorted(listed.values(), key=lambda r: r.file) if r.first_id is not None]
    assert firsts == sorted(firsts)
    assert rows_of(warc.read_warc(warc.write_warc(pages.limit(0), str(tmp_path / "c")), str(tmp_path / "c"))) == []


def brute_tokens(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    out, start = [], 0
    for d, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_encoder_is_the_library():
    enc = token_output.Encoder(queries.tokenizer_path(), max_cached=50)
    texts = ["", "a  b\n\n c", "it's  <|endoftext|> x", "été — 漢字 123abc", " lead", "tail  ", "  x", "don't'll 'S", "👩‍👧 á", "x" * 3000,
             "١٢٣ ½", "a\tb\r\n  \t c"]
    for _ in range(3):
        got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)]
        assert got == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_character_encodes_as_the_library_does():
    """Every character that texts are cut by here, in several places."""
    enc = token_output.Encoder(queries.tokenizer_path())
    texts = [f"a {c} {c}1 {c}{c}b'{c} 's{c}  {c}\n{c}" for c in map(chr, [*range(0x3200), *range(0x4E00, 0xA000, 7), *range(0xA000, 0x30000, 11)])
             if not 0xD800 <= ord(c) < 0xE000]
    texts += [t.replace("  ", " ").replace("\n", ".") for t in texts]
    assert enc.encode(texts) == enc._packed(texts)


def test_tokens(spark, edges, nothing, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(rows_of(queries.op3_token_output(spark, SF)))
    assert got == brute_tokens(sorted((r.doc_id, r.text) for r in docs.collect()))
    root = str(tmp_path / "t")
    out = sorted(rows_of(token_output.tokens_written(edges, root, queries.tokenizer_path(), min_shards=4, bucket_keys=10)), key=lambda r: r[1])
    assert len(out) == edges.count() and [r[0] for r in out] == sorted((r.doc_id for r in edges.collect()), key=lambda d: (d is not None, d))
    texts = defaultdict(set)
    for d, t in ((r.doc_id, r.text) for r in edges.collect()):
        texts[d].add(brute_tokens([(d, t)])[0][2:])
    start = 0
    for d, s, n, crc in out:
        assert s == start and (n, crc) in texts[d]
        start += n
    assert sum(os.path.getsize(os.path.join(root, f)) for f in os.listdir(root) if f.startswith("ids-")) == 2 * start
    # keyed access: known keys are found, others refused
    asked = spark.createDataFrame([(1,), (5,), (10**9,), (None,), (5,)], "k long")
    buckets = max(4, edges.count() // 10 + 1)
    assert sorted(r.key for r in token_output.lookup(asked, "k", root, buckets).collect()) == [1, 5]
    assert rows_of(token_output.tokens_written(nothing, str(tmp_path / "n"), queries.tokenizer_path())) == []


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        mph = token_output.PerfectHash.build(keys)
        assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
        again = token_output.PerfectHash.load(mph.dump())
        assert (again.slots(keys) == mph.slots(keys)).all()
    rest = token_output.PerfectHash([], np.array([3, 9]))
    assert rest.slots(np.array([9, 3, 4])).tolist() == [1, 0, -1]


def test_pipeline(spark, edges):
    import corpus_pipeline as p

    from .test_pair_operators import brute_items, brute_join
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, seen = docs, []
    for name, stage in p.STAGES:
        after = stage(spark, before, sf).cache()
        seen.append((name, before, after))
        if name != p.STAGES[-1][0]:
            assert after.columns == docs.columns, name
        before = after
    texts = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    _, a, b = seen[0]
    gone = set(ids(a)) - set(ids(b))
    assert len(gone) < 0.02 * a.count()
    _, a, b = seen[1]
    assert ids(b) == sorted({c for _, _, c, _ in brute_join(texts(a))})
    _, a, b = seen[2]
    bad = {d for d, *_ in brute_items(texts(a), [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])}
    assert bad and ids(b) == sorted(set(ids(a)) - bad)
    _, a, b = seen[3]
    copies, source = Counter(ids(b)), {r.doc_id: (r.source, len((r.text or "").split())) for r in a.collect()}
    assert max(copies.values()) <= 3 and set(copies) <= set(source)
    _, a, b = seen[4]
    assert sorted(rows_of(b), key=lambda r: r[1]) == brute_tokens(sorted(texts(a)))
    # empty and odd tables pass through every stage
    odd = edges.select("doc_id", "text", "lang", "source", "n_chars", "label", "shard", "_mix")
    for table in (odd, odd.limit(0)):
        for _, stage in p.STAGES:
            table = stage(spark, table, sf).cache()
            table.count()
    model = lang_id.fit(odd, lang_id.F.col("lang"))
    assert lang_id.in_known_language(odd, model, 0.0).count() == sum(r.lang_pred != "und" for r in lang_id.predict(odd, model).collect())


def test_words_encode_as_whole_texts_do():
    """Spaces, other white space, contractions and added tokens in any order,
    also while the encoder forgets its words between blocks."""
    import random

    from monthcast.llm.queries import tokenizer_path
    from monthcast.llm.token_output import Encoder

    rng = random.Random(5)
    parts = list(" \n\t\r\x0b\x1c\x1f\x85\xa0\u3000ab's1\u00b2\u0663_-.,\u0120\u00e9\u4e2d\u0440\U0001f600")
    parts += [" ", " ", "  ", "'ll", " the", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)]
    texts += ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "a\n  b"]
    encoder = Encoder(tokenizer_path(), max_cached=500)
    whole = encoder._packed(texts)
    assert [x for i in range(0, len(texts), 1000) for x in encoder.encode(texts[i: i + 1000])] == whole


def test_workers_give_back_what_a_task_has_freed():
    """Freed blocks under one that is kept would stay with the process."""
    import gc
    import os

    from monthcast.llm.common import given_back

    held = lambda: int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    kept = []

    def task(it):
        for x in it:
            blocks = [bytearray(b"x") * 60_000 for _ in range(3000)]
            kept.append(blocks[-1])
            yield x
            del blocks
            gc.collect()

    before = held()
    assert list(given_back(task)(iter([1, 2]))) == [1, 2]
    assert held() - before < 60e6
    assert len(kept) == 2
