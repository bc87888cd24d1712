import random

import pyarrow as pa
import pytest

from ledgerline.llm import line_dedup as q


def brute(rows, least):
    """Lines of a run of enough words that stood before, by comparing all runs."""
    seqs = []
    for _, text in rows:
        lines = (text or "").split("\n")
        seqs.append([(i, x) for i, x in enumerate(lines) if x.encode().split()])
    first, gone = {}, [set() for _ in rows]
    for d, seq in enumerate(seqs):
        for a in range(len(seq)):
            words = 0
            for b in range(a, len(seq)):
                words += len(seq[b][1].encode().split())
                if words >= least:
                    run = tuple(x for _, x in seq[a : b + 1])
                    if first.setdefault(run, (d, a)) != (d, a):
                        gone[d].update(seq[k][0] for k in range(a, b + 1))
    return ["\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in g) for (_, t), g in zip(rows, gone)], gone


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs, seed):
    chance = random.Random(seed)
    pool = [" ".join(chance.choice("abcdefgh") for _ in range(chance.randrange(1, 9))) for _ in range(9)]
    rows = [(i, "\n".join(chance.choice(pool + [""]) for _ in range(chance.randrange(25)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, "a b c d e f g h i j k l"), (104, "x\na b c d e f g h i j k l")]
    want, gone = brute(rows, 8)
    found = {r["doc_id"]: r for r in q.deduplicated(docs(rows), min_words=8).collect()}
    assert [found[i]["text"] for i, _ in rows] == want
    assert [found[i]["n_removed_lines"] for i, _ in rows] == [len(g) for g in gone]


def test_planted_passage(docs):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"intro one\n{passage}\nend"), (2, f"{passage}"), (3, f"other\n\n{passage}\nmore"), (4, "clean text\nclean text")]
    found = {r["doc_id"]: r for r in q.deduplicated(docs(rows)).collect()}
    assert [found[i]["n_removed_lines"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert found[3]["text"] == "other\n\nmore" and found[3]["first_keys"] == [1] and found[2]["text"] == ""


def test_windows():
    assert q.forward_ends([3, 4, 9, 1], 7) == [2, 3, 3, 0]
    assert q.backward_starts([3, 4, 9, 1], 7) == [-1, 0, 2, 2]
    assert q.fingerprints([5, 2, 2, 9], [3, 3, 4, 0]) == [2, 2, 2, -1]


def test_odd_rows(docs):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = q.deduplicated(docs([(None, passage), (None, passage), (1, passage), (1, passage)])).collect()
    assert sum(r["n_removed_lines"] for r in rows) == 3 and len(rows) == 4
    assert q.deduplicated(docs([])).count() == 0


def brute_words(rows, least):
    """Numbers of the words in a window that stood before, by comparing all windows."""
    first, gone = {}, []
    for d, (_, text) in enumerate(rows):
        words = (text or "").encode().split()
        gone.append(set())
        for a in range(len(words) - least + 1):
            if first.setdefault(tuple(words[a : a + least]), (d, a)) != (d, a):
                gone[-1].update(range(a, a + least))
    return gone


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_against_brute_force(docs, seed):
    """Passages that begin and end anywhere in lines, cut over other line ends than their copies."""
    chance, fresh = random.Random(seed), iter(range(10**6))
    pool = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(chance.randrange(4)):
            at = chance.randrange(len(pool))
            words += [f"u{next(fresh)}" for _ in range(chance.randrange(4))] + pool[at : at + chance.randrange(5, 20)]
        words += ["same"] * chance.choice([0, 0, 12])
        rows.append((i, "".join(w + chance.choice([" ", " ", "  ", "\n", "\n\n"]) for w in words)))
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, " ".join(pool[3:11])), (104, "x " + " ".join(pool[3:11]) + " y")]
    gone = brute_words(rows, 8)
    found = {r["doc_id"]: r for r in q.without_passages(docs(rows), min_words=8).collect()}
    for (i, text), out in zip(rows, gone):
        left = [w for n, w in enumerate((text or "").split()) if n not in out]
        assert found[i]["text"].split() == left and found[i]["n_removed_words"] == len(out)
        if not out:
            assert found[i]["text"] == (text or "")
    assert any(gone)


def test_passage_inside_a_line(docs):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"intro {passage} end"), (2, f"a b {passage} c\nmore"), (3, passage.replace(" ", "\n") + " tail"), (4, "clean")]
    found = {r["doc_id"]: r for r in q.without_passages(docs(rows)).collect()}
    assert [found[i]["n_removed_words"] for i in (1, 2, 3, 4)] == [0, 60, 60, 0]
    assert found[2]["text"] == "a b c\nmore" and found[2]["first_keys"] == [1]
    assert found[3]["text"] == "tail" and found[3]["n_removed_lines"] == 59
    assert q.without_passages(docs([])).count() == 0


def test_words_of():
    """Words as bytes.split() cuts them, over slices, empty texts and words of any length."""
    chance = random.Random(5)
    texts = ["".join(chance.choice("ab \n\t\r\x0b\x0c\u00e9") for _ in range(chance.randrange(60))).encode() for _ in range(50)]
    texts += [b"", b"x" * 8, b"x" * 9, b"x" * 64, b"x" * 65, b"x" * 200, b"x\x00", b"x", b" y" * 300]
    column = pa.array([b"before", *texts, b"behind"], pa.binary()).slice(1, len(texts))
    hashes, ends = q.words_of(column)
    known = {}
    for text, start, stop in zip(texts, ends, ends[1:]):
        words = text.split()
        assert len(words) == stop - start
        for word, value in zip(words, hashes[start:stop]):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    assert q.words_of(pa.array([], pa.binary()))[1].tolist() == [0]


def test_long_text_and_clashing_columns(ready, docs, tmp_path):
    """A text of 200,000 words beside short ones, in a table whose other columns have the names used inside."""
    chance = random.Random(6)
    long = [f"v{chance.randrange(10**9)}" for _ in range(200_000)]
    rows = [(1, " ".join(long)), (2, "intro " + " ".join(long[150_000:150_080]) + " end"), (3, "short"), (4, " ".join(long))]
    table = docs(rows).selectExpr(
        "doc_id", "text", "1 as mark", "2 as span", "3 as start", "4 as size", "'x' as at", "5 as doc_key", "6 as row_no", "7 as runs")
    table.write.parquet(str(tmp_path / "clash"))
    found = {r["doc_id"]: r for r in q.without_passages(ready.read.parquet(str(tmp_path / "clash"))).collect()}
    assert [found[i]["n_removed_words"] for i in (1, 2, 3, 4)] == [0, 80, 0, 200_000]
    assert found[2]["text"] == "intro end" and found[4]["text"] == "" and found[4]["first_keys"] == [1]


def test_hot_passage(docs):
    """One passage in most documents, with different surroundings: all but the first lose it, and nothing else."""
    passage = " ".join(f"w{i}" for i in range(70))
    rows = [(i, f"a{i} b{i}\n{passage} c{i}") for i in range(300)] + [(1000 + i, passage) for i in range(300)]
    found = {r["doc_id"]: r for r in q.without_passages(docs(rows)).collect()}
    assert found[0]["text"] == rows[0][1] and all(found[i]["text"] == f"a{i} b{i}\nc{i}" for i in range(1, 300))
    assert all(found[1000 + i]["text"] == "" and found[1000 + i]["first_keys"] == [0] for i in range(300))
