import hashlib
import random

import numpy as np
import pytest

from cyclebook.llm import suffix_sort as S
from cyclebook.llm import suffixes as X


def test_cover_reaches_every_pair_of_residues():
    on = set(S.COVER.tolist())
    for a in range(S.PERIOD):
        for b in range(S.PERIOD):
            d = int(S.SHIFT[a, b])
            assert (a + d) % S.PERIOD in on and (b + d) % S.PERIOD in on and d < S.PERIOD


def test_cover_ranks_order_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 2, 700).astype(np.uint8)
    padded = np.concatenate([text, np.zeros(8 * S.PERIOD, np.uint8)])
    words = np.ndarray((len(text) + 7 * S.PERIOD,), ">u8", padded.tobytes(), strides=(1,))
    ranks = S.cover_ranks(words, len(text))
    places = [p for p in range(len(text) - 128) if p % S.PERIOD in set(S.COVER.tolist())]
    strings = {p: text[p:p + 128].tobytes() for p in places}
    for p, q in zip(places, places[7:]):
        assert (ranks[p] < ranks[q]) == (strings[p] < strings[q]) and (ranks[p] == ranks[q]) == (strings[p] == strings[q])


@pytest.mark.parametrize("alphabet,copies", [(1, 3), (2, 4), (20, 6)])
def test_repeated_windows_equal_brute_force(alphabet, copies):
    rng = np.random.default_rng(alphabet)
    base = rng.integers(0, alphabet, 180).astype(np.uint8)
    segments = [base, *(np.where(rng.random(180) < 0.01, alphabet, base).astype(np.uint8) for _ in range(copies)),
                base[30:150], rng.integers(0, alphabet, 130).astype(np.uint8)]
    text = np.concatenate(segments)
    at, base_at = [], 0
    for s in segments:
        at += range(base_at, base_at + len(s) - S.LENGTH + 1)
        base_at += len(s)
    at = np.array(at)
    place = rng.permutation(len(at))
    strings = [text[a:a + S.LENGTH].tobytes() for a in at]
    first = {}
    for s, p in zip(strings, place.tolist()):
        first[s] = min(p, first.get(s, p))
    want = [first[s] != p for s, p in zip(strings, place.tolist())]
    for block in (1 << 15, 8):
        assert S.repeated_windows(text, at, place, block).tolist() == want


def brute(docs):
    seen, out = set(), []
    for key, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            seen.add(w)
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((key, len(data), int(gone.sum()), int((edge > 0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def fixture():
    rng = random.Random(11)
    words = ["an", "reth", "été", "ou", "ing", "sch", "\n", "漢字", "los", "x"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage, line = say(60), "This line of some length stands in very many of the documents that there are, word by word."
    docs = [say(rng.randrange(200)) for _ in range(60)]
    docs += [f"{say(20)} {passage} {say(20)}" for _ in range(25)] + [f"{say(4)} {line} {say(4)}" for _ in range(40)]
    docs += docs[:10] + [docs[3].replace("ou", "uo", 1), docs[4][50:], "a" * 800, "ab" * 300, "a" * 99, "a" * 100, "", None]
    docs += [docs[5] * 3, say(3000), "\x00" * 250]
    rng.shuffle(docs)
    return list(enumerate(docs))


def digest(rows):
    return [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in rows]


@pytest.mark.parametrize("pack_bytes,hot", [(2 << 20, 4096), (3000, 4096), (3000, 2), (1, 0)])
def test_passages_equal_brute_force(spark, pack_bytes, hot):
    docs = fixture()
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string").repartition(5)
    got = X.repeated_passages(table, pack_bytes=pack_bytes, hot_segments=hot).collect()
    assert sorted(digest(got)) == brute(docs)


def test_kept_text_is_what_the_spans_leave(spark):
    docs = fixture()[:40]
    rows = X.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True).collect()
    texts = dict(docs)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        cut = b"".join(data[a:b] for a, b in zip([0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(data)]))
        assert bytes(r.kept) == cut and hashlib.sha256(cut).hexdigest() == r.kept_sha256


def test_null_and_shared_ids(spark):
    text = "".join(random.Random(1).choices("abcdef ", k=150))
    rows = [(None, text), (5, text), (5, text), (2, text + "!")]
    got = X.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, len(r.spans)) for r in got) == [(-1, 0), (2, 1), (5, 1), (5, 1)]
    assert {r.doc_id: digest([r])[0][2] for r in got}[2] == 150


def test_empty_table(spark):
    assert X.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# Two texts that a polynomial hash of their bytes modulo 2^64 takes for one.
A = "ruavlnqhxbijpkdbaddzeptfjlgzewvwckrlsrnfznviixibkqdwihpxtwhavsqadnilvfqhhvdiddgtnlftvgbjetnmhnzftahy"
B = "qvbummphzbglnkfbabeyershgkhyhxtugkooortbxpxgkvefisdwkfnxxwharsuaamjkygllhtdidfippleutgehdumnimxhtaix"


@pytest.mark.parametrize("texts, removed", [((A, B, B), (0, 0, 100)), ((A, A, B, B), (0, 100, 0, 100)),
                                            (("z" + A, B, "x" + B + A), (0, 0, 200))])
def test_texts_made_to_collide_are_told_apart(spark, texts, removed):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(X.passage_digest(table).collect())
    assert tuple(r.n_removed for r in got) == removed


def test_the_key_and_the_number_of_buckets_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    parts = ["".join(rng.choices("ab c", k=150)) for _ in range(12)]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(6)))) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(str, X.repeated_passages(table).collect()))
    for key in (0, 1, 2 ** 64 - 1):
        monkeypatch.setattr(X.secrets, "randbits", lambda bits, key=key: key)
        assert sorted(map(str, X.repeated_passages(table, bucket_bytes=2000).collect())) == want


def test_ties_take_the_steps_of_their_own_size(monkeypatch):
    """Many pairs are no large group: each is compared once, however many there are."""
    asked, network = [], S._network
    monkeypatch.setattr(S, "_network", lambda n: asked.append(n) or network(n))
    rng = np.random.default_rng(5)
    one = rng.integers(0, 256, 5000, np.uint8)
    three = np.concatenate([one, one, one[:300]])
    at = np.concatenate([np.arange(0, 4900, 10), np.arange(5000, 9900, 10), np.arange(10_000, 10_200, 10)])
    got = S.repeated_windows(three, at, np.arange(len(at)))
    assert set(asked) == {2, 3}
    seen, want = set(), []
    for i in at.tolist():
        text = three[i:i + S.LENGTH].tobytes()
        want.append(text in seen)
        seen.add(text)
    assert got.tolist() == want


@pytest.mark.parametrize("around", [-101, -69, -32, -1, 0, 1, 68, 131])
def test_chunks_leave_no_seam(monkeypatch, around):
    """Segments are the same whatever number of places is hashed at a time."""
    rng = np.random.default_rng(7)
    data = rng.integers(0, 3, 4096 + around, np.uint8).tobytes() + b"ab" * 400 + b"c" * 300
    ends = np.array([900, 950, 950, 3000, len(data)])

    def segments(chunk):
        monkeypatch.setattr(X, "CHUNK", chunk)
        pack = X.Pack(data, ends, 12345)
        return [x.tolist() for x in (pack.start, pack.count, pack.anchor, pack.segment)]

    whole = segments(1 << 20)
    assert len(whole[0]) > 50 and segments(4096) == whole and segments(64) == whole
