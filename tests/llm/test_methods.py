"""The methods inside the corpus operators, piece by piece."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import decontamination, exact_dedup, html_extract, ngram_join, packing, phrase_dedup, pii, repeats, suffix_dedup
from orderloom.llm.arrow_text import Block, blocks, sequence_hash
from orderloom.llm.components import components


def block_of(*texts):
    (block,) = blocks(pa.array(texts), limit=1 << 30)
    return block


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=30), min_size=1, max_size=6))
def test_words_and_hashes(texts):
    block = block_of(*texts)
    starts, ends, firsts = block.words()
    found = [[block.data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(firsts, firsts[1:])]
    assert found == [t.encode().split() for t in texts]
    hashes = block.span_hash(starts, ends).tolist()
    flat = [w for row in found for w in row]
    assert len(set(hashes)) == len(set(flat)) == len(set(zip(flat, hashes)))
    assert len(sequence_hash(np.array(hashes, np.uint64), 2)) == max(0, len(flat) - 1)


def test_blocks_cover_sliced_columns_with_nulls():
    column = pa.array(["a", None, "bcd", "", "efgh", "i"]).slice(1)
    parts = list(blocks(column, limit=3))
    assert [part.text(r) for part in parts for r in range(part.rows)] == [b"", b"bcd", b"", b"efgh", b"i"]
    assert [part.first_row for part in parts] == [0, 3, 4]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=40).map(str.encode), min_size=1, max_size=5))
def test_two_stage_order_is_the_suffix_order(bodies):
    depth = 48
    lengths = np.array([len(b) for b in bodies])
    base = np.concatenate(([0], np.cumsum(lengths + depth)[:-1]))
    text = np.zeros(int((lengths + depth).sum()), dtype=np.uint8)
    real, suffixes = [], {}
    for at, body in zip(base.tolist(), bodies):
        text[at : at + len(body)] = np.frombuffer(body, np.uint8)
        for k in range(len(body) + 1):
            real.append(at + k)
            suffixes[at + k] = body[k:]
    order = suffix_dedup.two_stage_order(text, np.array(real), depth)
    assert sorted(order.tolist()) == sorted(real)
    assert [suffixes[p] for p in order.tolist()] == sorted(suffixes.values())


def test_suffix_finder_sorts_only_what_holds_a_window(monkeypatch):
    sorted_places = []

    def spy(text, real, depth, order=suffix_dedup.two_stage_order):
        sorted_places.append(len(real))
        return order(text, real, depth)

    monkeypatch.setattr(suffix_dedup, "two_stage_order", spy)
    draw = np.random.default_rng(7)
    bodies = [bytes(draw.integers(97, 123, 150).astype(np.uint8)) for _ in range(50)] + [b"z" * 150, b"short"]
    bodies += [bodies[3][:140]]
    numbers = np.arange(len(bodies))
    found = suffix_dedup.first_windows(bodies, numbers, numbers * 0, numbers * 0 + 1)
    # 51 places of each long body hold 100 bytes, and few follow until one is smaller than its successor; a run of z ends with the body
    assert sorted_places[0] < 51 * 60 + 100
    assert sorted(zip(*(c.tolist() for c in found))) == [(3, 0, 41, 3, 0), *[(50, k, k + 1, 50, 0) for k in range(51)], (52, 0, 41, 3, 0)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=6, max_size=20), min_size=1, max_size=6), st.booleans())
def test_finders_tell_first_places(texts, words):
    if words:
        bodies, window, finder = [" ".join(t).encode() for t in texts], 4, phrase_dedup.first_phrases
    else:
        bodies, window, finder = [t.encode() for t in texts], 4, suffix_dedup.first_windows
    ids = np.array([(7 * k) % 5 for k in range(len(texts))])
    starts = np.array([100 * k for k in range(len(texts))])
    found = finder(bodies, ids, starts, np.ones(len(texts), np.int64), window)
    places = {}
    for k, t in enumerate(texts):
        for n in range(len(t) - window + 1):
            places.setdefault(t[n : n + window], []).append((int(ids[k]), 100 * k + n))
    got = {}
    for segment, lo, hi, doc, start in zip(*(c.tolist() for c in found)):
        for n in range(lo, hi):
            got[segment, n] = (doc, start + n - lo)
    for k, t in enumerate(texts):
        for n in range(len(t) - window + 1):
            all_places = places[t[n : n + window]]
            if len(all_places) > 1:
                assert got[k, n][0] == min(all_places)[0]
                assert words or got[k, n] == min(all_places)
            else:
                assert (k, n) not in got


def test_runs_meet_wherever_a_window_repeats():
    rng = random.Random(1)
    shared = "".join(rng.choices("abcdef", k=100))
    texts = ["".join(rng.choices("abcdef", k=rng.randint(0, 90))) + shared + "".join(rng.choices("abcdef", k=50)) for _ in range(20)]
    row, start, number, anchor, digest, times = repeats.runs_of(block_of(*texts), repeats.Units(False, 100, 32))
    assert sum(number * times) == sum(len(t) - 99 for t in texts)
    holding = []
    for k, t in enumerate(texts):
        at = t.index(shared)
        holding.append([a for r, s, n, a in zip(row, start, number, anchor) if r == k and s <= at < s + n])
    assert all(len(h) == 1 for h in holding) and len({h[0] for h in holding}) == 1


def test_periodic_text_is_one_run(monkeypatch):
    block = block_of("word " * 500, "ab" * 300)
    assert repeats.runs_of(block, repeats.Units(True, 13, 5))[5].tolist() == [488]
    assert len(repeats.runs_of(block, repeats.Units(False, 100, 32))[0]) < 12
    monkeypatch.setattr(repeats, "MOST_TIMES", 100)
    assert repeats.runs_of(block, repeats.Units(True, 13, 5))[5].tolist() == [100, 100, 100, 100, 88]


def test_chunks_never_part_an_anchor(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 50)
    anchors = sorted(random.Random(2).choices(range(12), k=200))
    table = pa.table({"anchor": pa.array(anchors, pa.int64()), "body": pa.array([b"x" * (k % 23) for k in range(200)], pa.binary())})
    for size in (1, 7, 200):
        chunks = [c.column("anchor").to_pylist() for c in repeats._chunks(iter(table.to_batches(max_chunksize=size)))]
        assert [a for c in chunks for a in c] == anchors and len(chunks) > 3
        assert len({a for c in chunks for a in set(c)}) == sum(len(set(c)) for c in chunks)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 12), max_size=12))
def test_best_fit_decreasing_equals_piece_by_piece(histogram):
    plan = packing.best_fit_decreasing(histogram, 32)
    filled, pieces = {}, {}
    for length, rank, per, first, offset in plan.tolist():
        following = [r for n, r, *_ in plan.tolist() if n == length and r > rank]
        end = min(following, default=histogram[length])
        for k in range(rank, end):
            nth = k - rank
            filled.setdefault(first + nth // per, []).append((offset + nth % per * length, length))
            pieces[length, k] = True
    assert len(pieces) == sum(histogram.values())
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 32
    open_windows = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [w for w in range(len(open_windows)) if open_windows[w] >= length]
            best = min(fitting, key=lambda w: open_windows[w], default=None)
            if best is None:
                open_windows.append(32 - length)
            else:
                open_windows[best] -= length
    assert sorted(32 - w for w in open_windows) == sorted(sum(n for _, n in parts) for parts in filled.values())


def test_words_are_tokenised_as_in_their_text():
    import corpus_pipeline

    ids = packing.WordIds(corpus_pipeline.tokenizer_path())
    texts = [
        "It's <|endoftext|> A,B. don't!! 'Tis it's, x_y, 5th. a1.b2, ²³, Σας ΟΔΟΣ. İst b\tc a'' <|STARTOFTEXT|> ..., -a-",
        "näive  \n\n é,  x　y  z <|startoftext|>word, WORD### \U0001f600! \U0001f600‍\U0001f600", "", " ", "it'll, they're. I'VE! rock'n'roll's",
    ]
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts += [" ".join(letters), " ".join(random.Random(6).choice(["re", "Ta", ""]) + c + random.Random(ord(c)).choice(["x", "", "Ion"]) for c in letters)]
    found, firsts = ids.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert found[firsts[k] : firsts[k + 1]].tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=120), st.sets(st.integers(0, 400), min_size=1, max_size=120))
def test_bitmaps_bound_the_overlap(x, y):
    from orderloom.llm.arrow_text import mix

    a, b = (np.sort(mix(np.array(sorted(s), dtype=np.uint64) + np.uint64(1))) for s in (x, y))
    assert ngram_join.overlap_bound(ngram_join.bitmap(a), ngram_join.bitmap(b), len(a), len(b)) >= len(x & y)


def test_components_of_random_links(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500 + k, 501 + k) for k in range(64)]
    group = {n: n for e in edges for n in e}
    for _ in range(len(group)):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r["node"], r["component"]) for r in rows) == sorted((n, c) for n, c in group.items() if n in linked)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_block_max_wand_retrieves_all_above_the_threshold():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 25))) for _ in range(120)]
    mean = sum(len(t.split()) for t in texts) / len(texts)
    index = decontamination.ItemIndex(list(range(120)), texts, 120, mean, None, 0.4)
    for _ in range(60):
        query = decontamination.hashed_words(" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))).encode())
        scores = np.zeros(120)
        for term in np.unique(query).tolist():
            if term in index.postings:
                items, shares = index.postings[term]
                scores[items] += shares
        expected = [i for i in range(120) if scores[i] >= 0.4 - 1e-9]
        assert sorted(i for i, _ in index.search(query)) == expected
        reachable = index.candidates(np.zeros(len(query), np.int64), query)
        assert len(reachable) == 1 or not expected


def test_message_passing_is_exact():
    """Marginals equal sums over all labellings, and held-out pages are read right."""
    model = html_extract.train(count=60)
    page = html_extract.parse("<body><div class='ad'><p>x</p></div><article><p>y <a href=''>z</a></p><aside>w</aside></article></body>")
    n = len(page.tags)
    rows = html_extract.features(page)
    tables = {k: html_extract._table(model.pair, k) for k in ("plain", "telling")}
    total, content = 0.0, np.zeros(n)
    for state in np.ndindex(*(2,) * n):
        p = 1.0
        for k in range(n):
            e = 1 / (1 + np.exp(-sum(model.node.get(f, 0.0) for f in rows[k])))
            p *= e if state[k] else 1 - e
            if k:
                kind = "telling" if html_extract.is_telling(page, k) else "plain"
                p *= tables[kind][2 * state[page.parents[k]] + state[k]]
        total += p
        content += p * np.array(state)
    assert np.allclose(content / total, model.messages(page)[0])


def test_extraction_of_held_out_pages():
    model = html_extract.train()
    right = total = 0
    for source in html_extract.labelled_pages(100, seed=9):
        page = html_extract.parse(source)
        for label, p, tag in zip(page.labels, model.messages(page)[0], page.tags):
            right, total = right + (tag == "head" or label == (p >= 0.5)), total + 1
    assert right / total > 0.98


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body><nav>a</nav><main><h1>T&amp;C</h1><p>one<br>two <b>th</b>ree</p><!-- no --><script>x='</p>'</script></main></body>", "T&C one two three"),
        ("<article><p>a<p>b <table><tr><td>c<td>d</table><ul><li>e<li>f</ul></article><footer>g</footer>", "a b c d e f"),
        ("<article><p>kept</p><div class='comments'><div class='comment'><p>no</p></div></div><form><label>no</label></form></article>", "kept"),
        ("<div id='cookie-notice'>no</div><article>a &lt; b &#233; &nbsp; c", "a < b é c"),
        ("<aside class=sidebar>no</aside><article>x < y <3 <em>z</em></article>", "x < y <3 z"),
        ("<article title=\"a > b\">t</article><div class=\"advert banner\"><p>no", "t"),
    ],
)
def test_extraction_cases(source, text):
    assert html_extract.main_text(source, MODEL) == text


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body><header><button>no</header><article><p>kept</p></article></body>", "kept"),
        ("<body><button>no<article><p>kept</p></article></body>", "kept"),
        ("<body><select><option>no<option>no<article><p>kept</p></article></body>", "kept"),
        ("<body><header><object data=x></header><article><p>kept</p></article></body>", "kept"),
        ("<article><p>a <svg><svg><text>no</text></svg><text>no</text></svg> b</p></article>", "a b"),
        ("<article><p>a <button><div>no</div> no</button> b</p></article>", "a b"),
        ("<article><p>a <math><mi>x</mi></math> b <object>c</object></p></article>", "a x b c"),
        ("<article><p>one</p><noscript><p>two</p></article>", "one two"),
        ("<article><p>one</p><noscript><p>no</p></noscript><p>two</p></article>", "one two"),
        ("<body><template><nav>no</nav><article><p>kept</p></article></body>", "kept"),
    ],
)
def test_extraction_reads_on_after_elements_left_open(source, text):
    assert html_extract.main_text(source, MODEL) == text


MODEL = html_extract.train()


@pytest.mark.parametrize("start, end", [("<div>", "</span>"), ("<b>", "</i>"), ("<span>", "<td>"), ("<noscript>", "</template>")])
def test_ends_without_a_start_cost_no_search(start, end):
    assert html_extract.parse(start * 30_000 + end * 30_000 + "text").pieces[-1][1] == "text"


@pytest.mark.parametrize("largest", [True, False])
def test_rounds_of_runs_neither_shuffle_nor_sort(spark, largest):
    docs = spark.range(0, 500, 1, 8).selectExpr("IF(id = 3, NULL, id) AS doc_id", "string(id % 7) AS text")
    merged = exact_dedup.merge_runs(exact_dedup.digest_records(docs), 8, largest)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(x) for x in ("Exchange ", "Sort [", "SortAggregate(")] == [2, 1, 6]
    stays = {k: (max if largest else min)(i for i in range(k, 500, 7) if i != 3) for k in range(7)}
    assert {(r["keep_id"], r["group_size"]) for r in merged.collect()} == {(i, len(range(k, 500, 7))) for k, i in stays.items()}


def test_labeler_reliability_is_estimated():
    """Votes drawn from known reliabilities: the posterior puts the right patterns above one half."""
    rng = random.Random(5)
    counts: dict[str, float] = {}
    for _ in range(4000):
        truth = rng.random() < 0.3
        votes = "".join("y" if (rng.random() < right) == truth else "n" for right in (0.95, 0.9, 0.85, 0.8))
        counts[votes] = counts.get(votes, 0) + 1
    posterior = pii.expectation_maximisation(counts)
    assert posterior["yyyy"] > 0.95 and posterior["nnnn"] < 0.05 and posterior["yynn"] > 0.5 > posterior["nnyy"]
