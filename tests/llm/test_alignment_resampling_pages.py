"""Tokenizer alignment, importance resampling and main-text extraction against plain versions."""

import bisect
import collections
import hashlib
import html
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from goldleaf.llm import html_main_text, importance_resampling, token_alignment
from goldleaf.llm.bpe_words import byte_symbols

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD_TEXTS = [
    None, "", " ", "  ", "a", "\n\n x", "don't  stop\t now ", "éÉ ñ 中文 \U0001F600 ½² ª\xa0x", "x" * 3000,
    "a <|endoftext|> b<s> </s><0x41>", "the of and " * 2000, "\x00\x1c \x85 ", "same text", "same text", "low ▁line", "A-b_C9 Ab",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts under null and repeated ids, with further columns whose names clash."""
    rows = [(None if i in (3, 5) else 7 if i in (8, 9) else i, t, i, "k", 1, None) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, uid int, _text string, score int, rank int")


# --- alignment -------------------------------------------------------------------------------------------

def plain_alignment(texts):
    """Counts, digest and corpus sums of every text, token by token."""
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = {s: i for i, s in enumerate(byte_symbols())}

    def spans(tokens):
        out, at = [], 0
        for i, data in tokens:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out

    found, count = [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        e = a_side.encode(whole.decode(), add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = [(i, bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode())
             for i in b_side.encode(text or "") for p in [b_side.id_to_piece(i)]]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append((0, 0, 0, "", []))
            continue
        a, b = spans(a), spans(b)
        links, first = [], 0
        for i, start, end in a:
            while b[first][2] <= start:
                first += 1
            for j, low, high in b[first:]:
                if low >= end:
                    break
                links.append((i, j))
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = [([], []) for _ in common]
        for side, tokens in enumerate((a, b)):
            for i, _, end in tokens:
                groups[bisect.bisect_left(common, end)][side].append(str(i))
        digest = hashlib.sha256(";".join(",".join(x) + "|" + ",".join(y) for x, y in groups).encode()).hexdigest()
        found.append((len(a), len(b), len(groups), digest, links))
        count.update(set(links))
    best = collections.defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(n_a, n_b, n_groups, len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), digest)
            for n_a, n_b, n_groups, digest, links in found]


def aligned(rows):
    return sorted(str((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]))
                  for r in rows)


@pytest.mark.parametrize("few", [True, False])
def test_alignment_matches_plain_tokens(spark, odd, monkeypatch, few):
    """With the pairs broadcast and shuffled, and batches of a few texts."""
    if not few:
        monkeypatch.setattr(token_alignment, "PAIRS_BROADCAST", 0)
    monkeypatch.setattr(token_alignment, "BATCH_BYTES", 4000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(
        odd.select("doc_id", "text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(str((d, *x)) for (d, _), x in zip(rows, plain_alignment([t for _, t in rows])))
    assert aligned(token_alignment.align_tokenizers(docs).collect()) == want
    assert aligned(token_alignment.align_tokenizers(docs.where("doc_id < 0")).collect()) == []


def test_alignment_of_odd_columns(odd):
    want = sorted(str((r["doc_id"], *x)) for r, x in zip(odd.collect(), plain_alignment(ODD_TEXTS)))
    assert aligned(token_alignment.align_tokenizers(odd).collect()) == want


def test_chunks_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNKS_KEPT", 5)
    sides = token_alignment._Sides(*map(public_tokenizers.path, (token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B)))
    texts = [f"word{i} and  gaps {i}".encode() for i in range(40)]
    once = [x.tolist() for part in token_alignment.tokenized(sides, texts) for x in part]
    for _ in range(2):
        assert [x.tolist() for part in token_alignment.tokenized(sides, texts) for x in part] == once
    assert len(sides.number) < 60 and all(len(c) <= token_alignment.LONGEST_KEPT for c in sides.number)


# --- resampling ------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000
                        for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resampling(rows, targets, least=20, percent=5):
    docs, source, target = [(d, *plain_features(t)) for d, t in rows], collections.Counter(), collections.Counter()
    for _, _, f in docs:
        source.update(f)
    for t in targets:
        target.update(plain_features(t)[1])
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = lambda k: math.floor(1000 * math.log((target[k] + 1) * (s_all + 10_000) / ((source[k] + 1) * (t_all + 10_000))))
    out = []
    for d, n, f in docs:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    drawn = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is not None, x[0] or 0, -x[2]))
    for k, x in enumerate(drawn[:percent * len(drawn) // 100]):
        x[5] = k + 1
    return sorted(str((x[0], *x[2:])) for x in out)


def resampled(frame):
    return sorted(str((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in frame.collect())


@pytest.mark.parametrize("rank_rows", [1_000_000, 50])
def test_resampling_matches_plain_features(spark, monkeypatch, rank_rows):
    monkeypatch.setattr(importance_resampling, "RANK_ROWS", rank_rows)  # small: ranked in many ranges
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows, targets = [(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()]
    want = plain_resampling(rows, targets)
    assert resampled(importance_resampling.resample(docs, target)) == want and sum(not x.endswith("None)") for x in want) > 40


def test_resampling_of_odd_tables(spark, odd, monkeypatch):
    monkeypatch.setattr(importance_resampling, "BATCH_BYTES", 100)
    target = odd.where("uid >= 10")
    got = resampled(importance_resampling.resample(odd, target, least_words=1, percent=50))
    assert got == plain_resampling([(r["doc_id"], r["text"]) for r in odd.collect()], [r["text"] for r in target.collect()], 1, 50)
    nothing = odd.where("uid < 0")
    assert resampled(importance_resampling.resample(odd, nothing)) == plain_resampling(
        [(r["doc_id"], r["text"]) for r in odd.collect()], [])
    assert resampled(importance_resampling.resample(nothing, target)) == []


def test_matrix_of_rows_gives_their_crc():
    rng = np.random.default_rng(4)
    for width in (0, 1, 2, 7, 300):
        rows = rng.integers(0, 256, (17, width)).astype(np.uint8)
        assert importance_resampling.crc_of_rows(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


# --- pages -----------------------------------------------------------------------------------------------

def test_articles_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_main_text.extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        text = "\n".join(b for b in blocks if b)
        mine = got[r["page_id"]]
        assert (mine["text"], mine["n_chars"], mine["url"]) == (text, len(text), r["url"])


LONG = "A sentence of the story that has by far enough characters of its own to be taken for a text, and some more."
PAGES = [
    (None, ""), ("", ""), ("   \n", ""), ("only", "only"), ("a < b and c > d", "a < b and c > d"),
    ("<script>x<p>y</script>", ""), ("<!-- <p>x</p> --><p>y", "y"), ("<!-- never closed <p>x", ""), ("<p title='a>b'>x</p>", "x"),
    ("<p>&lt;b&gt; &amp;amp; &#233;&nbsp;&nbsp;x &unknown; &copy", "<b> &amp; é x &unknown; ©"),
    (f"<title>T</title><nav><p>{LONG}</nav><div><p>{LONG}<br>more\n text</p><p>End.</div><footer>{LONG}</footer>",
     f"{LONG} more text\nEnd."),
    (f"<header><p>{LONG}</p></header><div class='has-sidebar page'><div class='post-header'><h2>Head</h2></div><p>{LONG}"
     f"<div id=sidebar><p>{LONG}</div><div class='cookieNotice'>{LONG}</div><p>Tail</div>", f"Head\n{LONG}\nTail"),
    (f"<div><p>{LONG}</div><div class='comments'><p>{LONG}</div><form>{LONG}</form><div hidden>{LONG}</div>"
     f"<div style='display: none'>{LONG}</div><div role=navigation>{LONG}</div><aside>{LONG}</aside>", LONG),
    (f"<article><p>Be.</article><div>{LONG}</div>", "Be."),
    (f"<main><p>One <b>bold</b> word.<div class=ad>{LONG}</div><ul><li>item<li>other</ul><p>Two", "One bold word.\nitem\nother\nTwo"),
    (f"<p>{LONG}</p>" + "".join(f"<p><a href=/{i}>A link that leads to somewhere else, number {i}</a></p>" for i in range(9)), LONG),
    ("<article><h1>T</h1>" + "<p>word </p>" * 3000 + "</article>", "T\n" + "\n".join(["word"] * 3000)),
    ("<div>" * 3000 + LONG, LONG), ("<article><p>café \U0001F600</p></article>", "café \U0001F600"),
]


def test_odd_pages(spark):
    rows = [(None if i == 2 else i % 5, p, f"u{i}", i, "x") for i, (p, _) in enumerate(PAGES)]
    frame = spark.createDataFrame(rows, "page_id bigint, html string, url string, n_chars int, text string")
    got = html_main_text.extract_main_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    mine = {r["url"]: r for r in got.collect()}
    for i, (page, text) in enumerate(PAGES):
        assert (mine[f"u{i}"]["text"], mine[f"u{i}"]["n_chars"]) == (text, len(text)), page
    assert html_main_text.extract_main_text(frame.where("page_id < 0")).collect() == []


def test_surge_and_dive_points():
    runs = html_main_text.text_runs([0, 5, 0, 0, 0, 40, 50, 0, 0, 9, 0, 0, 0, 30, 0], window=3, surge=60)
    assert runs == [(5, 10)]
    assert html_main_text.text_runs([0, 5, 0], window=3, surge=60) == [(1, 2)]  # a page with little text
    assert html_main_text.text_runs([0, 4, 3, 70, 0], window=3, surge=60) == [(1, 4)]  # short lines lead up to it
    assert html_main_text.text_runs([]) == []
