"""Token store and packing against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wavecohort.llm import bpe_ids, packing, token_store


@pytest.fixture(scope="module")
def library(request):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


PIECES = st.lists(
    st.one_of(st.text(max_size=8), st.sampled_from([" ", "  ", " \n", "\n\n", "\t", "'s", "<|endoftext|>", "\x1c", "\x85", "a", "1"]))
)


@settings(max_examples=200, deadline=None)
@given(PIECES)
def test_ids_equal_the_library(parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "".join(parts)
    [ids] = bpe_ids.encode_documents([text], path)
    global _LIBRARY
    _LIBRARY = globals().get("_LIBRARY") or Tokenizer.from_file(path)
    assert ids.tolist() == _LIBRARY.encode(text, add_special_tokens=False).ids + [0]


def test_spelled_words_equal_the_library(tokenizer, library):
    from tokenizers import pre_tokenizers

    words = [" a", " Zürich", " naïve", " 漢字", " don't.", " \U0001f600x", " " + "long" * 40, " ÿ\u0120"]
    ids, starts = bpe_ids.PieceCache(tokenizer).spelled(words)
    library = type(library).from_file(tokenizer)
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [ids[a:b].tolist() for a, b in zip(starts, [*starts[1:], len(ids)])] == want


def test_laying_blocks_gives_back_the_encoders_memory(tokenizer):
    from wavecohort.llm import common

    first = bpe_ids.piece_cache(tokenizer)
    assert bpe_ids.piece_cache(tokenizer) is first
    common.drop_worker_caches()
    common.drop_worker_caches()  # nothing is left to drop
    assert bpe_ids.piece_cache(tokenizer) is not first


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


ROWS = [(5, "five words are in here"), (2, None), (9, ""), (2, "again two"), (None, "no id"), (7, "long " * 3000)]


def store(spark, documents, rows, tmp_path, tokenizer, **more):
    folder = str(tmp_path / "store")
    token_store.write_store(documents(rows), folder, token_store.StoreSettings(tokenizer=tokenizer, **more))
    return folder


def test_store_round_trip(spark, documents, library, tokenizer, tmp_path):
    folder = store(spark, documents, ROWS, tmp_path, tokenizer, block_documents=2)
    got = token_store.read_store(spark, folder).collect()
    got.sort(key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in want]
    start = 0
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert any(ids == ids_of(library, t) for d, t in ROWS if d == r.doc_id)
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
    [one] = token_store.read_store(spark, folder, [7]).collect()
    assert np.frombuffer(one.ids, dtype="<u4").tolist() == ids_of(library, "long " * 3000)
    assert token_store.read_store(spark, folder, [6]).count() == 0


def test_store_with_a_trained_dictionary(spark, sf, library, tokenizer, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = str(tmp_path / "s")
    token_store.write_store(docs, folder, token_store.StoreSettings(tokenizer=tokenizer, dictionary_bytes=4096))
    [d] = spark.read.parquet(f"{folder}/dictionary").collect()
    assert len(d.dictionary) > 256
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = token_store.read_store(spark, folder).collect()
    assert {r.doc_id: crc(np.frombuffer(r.ids, dtype="<u4")) for r in got} == {k: crc(ids_of(library, t)) for k, t in texts.items()}


def test_empty_store(spark, documents, tmp_path, tokenizer):
    folder = store(spark, documents, [], tmp_path, tokenizer)
    assert token_store.read_store(spark, folder).count() == 0


def check_packing(rows, out, library, capacity):
    """Every token of every row in exactly one place, nothing over capacity."""
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text in rows:
        ids = ids_of(library, text)
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(str(doc_id), k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    return len(sequences), -(-sum(w[3] for w in want) // capacity)


def test_packing_documents(spark, sf, library, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = packing.pack_documents(docs, packing.PackSettings(tokenizer=tokenizer)).collect()
    used, least = check_packing([(r.doc_id, r.text) for r in docs.collect()], out, library, 2048)
    assert used <= least + 1


def test_packing_edge_rows_and_groups(documents, library, tokenizer):
    rows = ROWS + [(3, "x")] * 40 + [(11, "b c d"), (12, "e " * 31)]
    settings_ = packing.PackSettings(tokenizer=tokenizer, capacity=32, group_pieces=16, islands=3)
    out = packing.pack_documents(documents(rows), settings_).collect()
    check_packing(rows, out, library, 32)
    assert packing.pack_documents(documents([]), settings_).count() == 0


def test_genetic_steps_keep_every_item():
    rng = np.random.default_rng(4)
    settings_ = packing.PackSettings(capacity=100, children=30, population=6)
    lengths = [int(x) for x in rng.integers(20, 60, size=120)]
    people = packing.first_population(lengths, settings_, rng)
    first = len(people[0])
    after = packing.evolve(lengths, people, settings_, rng)
    for bins in after:
        assert sorted(i for b in bins for i in b) == list(range(120))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
        assert packing.numbers_to_bins(packing.bins_to_numbers(bins, 120)) is not None
    assert packing.lower_bound(lengths, 100) <= len(after[0]) <= first
    assert packing.fitness(after[0], lengths, 100) <= packing.fitness(people[0], lengths, 100)


def dictionary_of(spark, folder):
    return bytes(spark.read.parquet(folder + "/dictionary").first()["dictionary"])


def test_a_dictionary_at_every_size(spark, documents, tokenizer, sf, tmp_path):
    """Given documents, one hot text among others, and tables too small for
    the trainer."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    settings = token_store.StoreSettings(tokenizer=tokenizer)
    token_store.write_store(docs, str(tmp_path / "given"), settings)
    assert len(dictionary_of(spark, str(tmp_path / "given"))) > 1000
    texts = [r.text for r in docs.select("text").collect()]
    hot = documents([(i, texts[0]) for i in range(20_000)] + [(50_000 + i, t) for i, t in enumerate(texts)])
    token_store.write_store(hot, str(tmp_path / "hot"), settings)
    assert len(dictionary_of(spark, str(tmp_path / "hot"))) > 1000
    assert token_store.read_store(spark, str(tmp_path / "hot")).count() == 20_000 + len(texts)
    small = store(spark, documents, [(1, "one small text")], tmp_path, tokenizer)
    assert dictionary_of(spark, small) and token_store.read_store(spark, small).first()["n_tokens"] > 3


def test_equal_rows_are_split(spark, documents, library, tokenizer, tmp_path):
    rows = [(4, "the same row again")] * 900 + [(i, f"other {i}") for i in range(100)]
    folder = str(tmp_path / "split")
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        token_store.write_store(documents(rows).repartition(4), folder, token_store.StoreSettings(tokenizer=tokenizer))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    blocks = spark.read.parquet(folder + "/blocks").collect()
    hot = [sum(d == 4 for d in b.doc_ids) for b in blocks]
    assert sum(hot) == 901 and max(hot) < 450
    got = sorted(token_store.read_store(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_long_texts_and_own_columns(spark, documents, library, tokenizer, tmp_path):
    from test_simhash import clashing

    text = "many words in one text " * 40_000
    token_store.write_store(clashing(documents([(1, text), (2, "b")])), str(tmp_path / "s"), token_store.StoreSettings(tokenizer=tokenizer))
    long, short = sorted(token_store.read_store(spark, str(tmp_path / "s")).collect(), key=lambda r: r.start)
    assert np.frombuffer(long.ids, "<u4").tolist() == ids_of(library, text) and short.n_tokens == 2


def triplets(n, seed, capacity=1000):
    """Pieces that fill ``n`` bins exactly, three a bin: hard for best fit."""
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        a = int(draw.integers(380, 490))
        b = int(draw.integers(250, 1000 - a - 250))
        out += [a, b, capacity - a - b]
    return [out[i] for i in draw.permutation(len(out))]


def pieces_frame(spark, lengths):
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, packing.PIECES).repartition(3)


def bins_of(packed, lengths, capacity):
    """Checks every piece's place; the number of sequences."""
    rows = packed.collect()
    assert sorted(r.row for r in rows) == list(range(len(lengths)))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        items.sort()
        ends = np.cumsum([n for _, n in items])
        assert [o for o, _ in items] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(by)


def test_genetic_steps_beat_best_fit(spark):
    lengths = triplets(60, 3)
    best_fit = len(packing.pack(packing.longest_first(range(len(lengths)), lengths), lengths, 1000))
    settings_ = packing.PackSettings(capacity=1000, children=60, population=8, islands=3, patience=6)
    found = bins_of(packing.pack_pieces(pieces_frame(spark, lengths), settings_), lengths, 1000)
    assert 60 <= found < best_fit


def test_loose_bins_of_all_groups_are_packed_again(spark):
    """Many small groups lose a bin each at their border; the levels win most
    of them back."""
    lengths = [int(x) for x in np.random.default_rng(9).integers(1, 60, 1500)]
    least = packing.lower_bound(lengths, 100)
    settings_ = packing.PackSettings(capacity=100, group_pieces=60, opened=0.1)
    found = bins_of(packing.pack_pieces(pieces_frame(spark, lengths), settings_), lengths, 100)
    assert found <= least + 6  # 25 groups


def optimum(lengths, capacity):
    """The fewest bins, by trying all."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            if b + lengths[i] <= capacity:
                rest = list(bins)
                rest[rest.index(b)] = b + lengths[i]
                place(i + 1, rest)
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(5, 60), min_size=1, max_size=9), st.integers(0, 5))
def test_small_cases_reach_the_optimum(lengths, seed):
    lengths = sorted(lengths, reverse=True)
    settings_ = packing.PackSettings(capacity=100, children=40, population=6)
    rng = np.random.default_rng(seed)
    people = packing.evolve(lengths, packing.first_population(lengths, settings_, rng), settings_, rng)
    assert len(people[0]) == optimum(lengths, 100)


def test_a_packing_is_scored_once(monkeypatch):
    lengths = np.random.default_rng(1).integers(300, 1200, 200).tolist()
    settings_, seen = packing.PackSettings(), []
    rng = np.random.default_rng(2)
    people = packing.first_population(lengths, settings_, rng)
    plain = packing.fitness
    monkeypatch.setattr(packing, "fitness", lambda *a: seen.append(1) or plain(*a))
    out = packing.evolve(lengths, people, settings_, rng)
    assert len(people) < len(seen) <= len(people) + settings_.children
    scores = [plain(p, lengths, settings_.capacity) for p in out]
    assert scores == sorted(scores)
    assert all(sorted(i for b in p for i in b) == list(range(len(lengths))) for p in out)


def test_met_pieces_have_codes(tokenizer, library, monkeypatch):
    """Every distinct pre-token goes to the library once, in lists that each are
    one call; those who forget them give the same ids."""
    given, real = [], bpe_ids.PieceCache._library
    monkeypatch.setattr(bpe_ids.PieceCache, "_library", lambda self, texts, t=None: given.append(list(texts)) or real(self, texts, t))
    word = lambda j: str(j).translate(str.maketrans("0123456789", "abcdefghij"))
    texts = [" ".join(f"w{word(j)}é the\n日本 x" for j in range(i, i + 300)) for i in range(0, 900, 100)] + ["", "a", " ", "<|endoftext|> the"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    cache = bpe_ids.PieceCache(tokenizer, keep=100)
    for a in range(0, len(texts), 2):
        assert cache.encode(texts[a : a + 2]) == want[a : a + 2]
    cache, given[:] = bpe_ids.PieceCache(tokenizer), []
    assert cache.encode(texts) == want and len(cache.starts) == len(cache)
    lists = [g for g in given if any(" " in t for t in g) and g != ["<|endoftext|> the"]]
    assert len(lists) > 3 and all(len(g) == 1 for g in lists)
    given.clear()
    assert cache.encode(texts[:-1]) == want[:-1] and not any(map(any, given))


def test_frequent_pieces_stay_beyond_the_bound(tokenizer, library, monkeypatch):
    """Beyond the bound of a worker's pieces, those that texts share aren't
    encoded again; the ids are the library's in every text, by each pattern."""
    word = lambda j: "q" + str(j).translate(str.maketrans("0123456789", "abcdefghij"))
    common = " ".join(f"often{word(j)}" for j in range(40)) + " it's 12 é ć é!\t1"
    texts = [common + " " + " ".join(f"rare{word(j)}" for j in range(i, i + 30)) + tail for i in range(0, 600, 30) for tail in ("", " þ²", " ǅ", " я")]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    learned, real = [], bpe_ids.PieceCache.ids_of
    monkeypatch.setattr(bpe_ids.PieceCache, "ids_of", lambda self, pieces: learned.extend(pieces) or real(self, pieces))
    cache = bpe_ids.PieceCache(tokenizer, keep=200)
    assert [cache.encode([t])[0] for t in texts] == want
    assert learned.count(" often" + word(5)) == 1 < len(set(learned)) // 200
    assert len(cache) <= 200 + 90 and len(cache) == len(cache.words) == len(cache.starts) == len(cache.met)
    assert all(cache.words[code] == piece for piece, code in cache.items())
