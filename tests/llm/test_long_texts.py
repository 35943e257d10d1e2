"""Very long and deeply nested inputs, and operators against plain versions of their inner steps."""

import random
import struct
import time

import numpy as np
import public_tokenizers
from test_operators import brute_base, brute_lines, brute_quality, brute_simhash, prose

from lodestream.llm import bpe, html_extract, langid, line_dedup, media, packing, pii, quality, simhash, suffix_dedup


def test_html_is_linear():
    start = time.process_time()
    assert html_extract.main_text("<div>" * 100_000 + "deep text" + "</div>" * 100_000) == "deep text"
    for page in ("<table><td>" + "<div>" * 50_000 + "<p>x</b>" * 50_000, "<p>a<li>" * 50_000, "<b>" * 50_000 + "<article>" + "<div></b>" * 50_000 + "z"):
        assert html_extract.main_text(page)
    assert time.process_time() - start < 60


def test_html_keeps_parts_of_the_article():
    inner = '<h2 id="related-work">Related</h2><p class="byline">By X</p><section id="discussion"><p>Some, talk.</p></section><figure><img><figcaption>Cap</figcaption></figure><div class="legal">Legal text</div><p>Body, one.</p>'
    links = '<div class="tags"><a href=1>t1</a></div>'
    second = "<article><p>Second, part, of it, all that is long enough to count as text for the sum of the points that it gets.</p></article>"
    text = html_extract.main_text(f"<body><nav>Menu</nav><article>{inner}{links}</article>{second}<aside>Side</aside></body>")
    assert text.split("\n\n") == ["Related", "By X", "Some, talk.", "Cap", "Legal text", "Body, one.", "Second, part, of it, all that is long enough to count as text for the sum of the points that it gets."]


def test_language_of_long_words(spark):
    tail = {"de": "x" * 60 + "ungen", "fr": "y" * 60 + "eaux"}
    rows = [(i, " ".join([tail["de" if i % 2 else "fr"]] * 80), "de" if i % 2 else "fr") for i in range(90)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    # Counts are whole: 80 in each of the sampled documents, and n-grams reach to the words' ends.
    assert {"ungen", "eaux>"} <= set(model.grams)
    best = lambda w: model.langs[int(model.score(w).argmax())]
    assert best("z" * 5000 + "ungen") == "de" and best("z" * 5000 + "eaux") == "fr"


def test_every_language_is_learned(spark):
    rows = [(i, f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q " * 30, f"l{i % 1200}") for i in range(3600)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {r["lang"] for r in df.filter(~langid.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    assert set(langid.train(df).langs) == seen and len(seen) > 1000


def test_vocabulary_is_cut_by_whole_words(spark):
    rows = [(i, "common " * 5 + ("rare " if i % 7 == 0 else "other "), ["en", "de", "fr"][i % 3]) for i in range(200)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_words=1)
    assert list(model.words) == ["common"] and np.ptp(model.word_rows[0]) < 1


def long_texts():
    r = random.Random(2)
    return [prose(1, 600_000), "".join(r.choice("abcdef") for _ in range(300_000)), " " * 200_000 + "x", "ab  \n" * 100_000, "é" * 200_000]


def test_packing_and_encoding_of_long_texts():
    from tokenizers import Tokenizer

    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = Tokenizer.from_file(path)
    for text in long_texts():
        want = made.encode(text, add_special_tokens=False).ids
        for got in (packing._encoder(path)(text), bpe._pieces(ranks, public_tokenizers.PATTERN).code([text])[0]):
            assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want


def test_packing_ids_are_the_tokenizer_s():
    from tokenizers import Tokenizer

    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(1)
    made = Tokenizer.from_file(path)
    texts = ["".join(r.choice("ab cde'st  \n\t0123.,;:éß🙂漢  ZQ<|endoftext|>") for _ in range(r.randrange(400))) for _ in range(2000)]
    texts += ["a" * n for n in range(1, 200)] + ["".join(chr(r.randrange(32, 0x2FFF)) for _ in range(60)) for _ in range(500)] + ["<|endoftext|>", " " * 600 + "x", "y" * 3000]
    encode = packing._encoder(path)
    for text, want in zip(texts, made.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encode(text), "<u4").tolist() == want.ids, text
    assert np.frombuffer(encode("<|endoftext|> a"), "<u4").tolist() == [50256, 257]


def plain_features(payload, frame, hop, bands, reach):
    """Peak pairs by a direct transform of each frame."""
    signal = np.frombuffer(payload, np.uint8).astype(float) - 128
    n = max(1, 1 + -(-(len(signal) - frame) // hop))
    signal = np.pad(signal, (0, max(0, (n - 1) * hop + frame - len(signal))))
    window = np.hanning(frame)
    peaks = []
    for i in range(n):
        magnitude = np.abs(np.fft.rfft(signal[i * hop : i * hop + frame] * window))
        edges = [*bands, len(magnitude)]
        peaks.append([(lo + int(magnitude[lo:hi].argmax())) for lo, hi in zip(edges, edges[1:], strict=False)])
    return sorted((t, a << 16 | b << 4 | far) for t in range(n) for far in range(1, reach + 1) if t + far < n for a in peaks[t] for b in peaks[t + far])


def test_media_features_are_those_of_a_plain_transform(monkeypatch):
    bands, same = (1, 16, 48), []
    for block in (7, 1 << 13):
        monkeypatch.setattr(media, "BLOCK_FRAMES", block)
        for text in ("", prose(3, 30), prose(4, 400), "é🙂" * 900, "x" * 1000):
            payload = media.read_wav(media.write_wav((data := text.encode()) + bytes(-len(data) % 64 or (0 if data else 64)), 8000))
            times, hashes = media.peak_pairs(media.spectral_peaks(np.frombuffer(payload, np.uint8), 256, 128, bands), 2)
            got, want = list(zip(times.tolist(), hashes.tolist(), strict=True)), plain_features(payload, 256, 128, bands, 2)
            assert [t for t, _ in got] == [t for t, _ in want]
            same.append(sum(a == b for a, b in zip(got, want, strict=True)) / max(1, len(want)) if want else 1)
    # Single and double precision may differ where two bins are all but equal.
    assert min(same) > 0.99


def test_media_of_a_long_text():
    payload = prose(5, 1_500_000).encode()
    payload += bytes(-len(payload) % 64)
    peaks = media.spectral_peaks(np.frombuffer(payload, np.uint8), 256, 128, (1, 16, 48))
    times, hashes = media.peak_pairs(peaks, 2)
    assert len(peaks) == 1 + -(-(len(payload) - 256) // 128) and len(times) == len(hashes) == 9 * (2 * len(peaks) - 3) and (np.diff(times) >= 0).all()


LONG = "doc_id long, text string, source string"


def test_long_texts_of_the_joining_operators(spark):
    """Whole texts of a few MB against the plain versions: fingerprints, rules, spans, repeats, lines."""
    r = random.Random(4)
    lines = "\n".join(prose(i, 12) for i in range(8_000))
    contacts = " ".join(f"u{i}@mail{r.randrange(9)}.org {prose(i, 8)} 10.0.{i % 256}.{i % 251} +1 988 555 {i % 10_000:04d}" for i in range(9_000))
    texts = [prose(7, 150_000), lines, contacts, lines + "\nend"]
    df = spark.createDataFrame([(i, t, f"s{i % 2}") for i, t in enumerate(texts)], LONG)
    rows = df.collect()
    assert {x["doc_id"]: x["fp"] & (1 << 64) - 1 for x in simhash.near_duplicates(df).collect()} == {i: brute_simhash(t) for i, t in enumerate(texts)}
    got = {x["doc_id"]: (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) for x in quality.judge_documents(df).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}
    kinds = {k: n for n, k in enumerate(pii.BASE_KINDS)}
    found = {x["doc_id"]: [(kinds[s["kind"]], s["start"], s["end"]) for s in x["base"]] for x in pii.find_spans(df).collect()}
    assert found == {i: sorted(brute_base(t), key=lambda s: s[:2]) for i, t in enumerate(texts)}
    kept = {x["doc_id"]: (x["n_removed"], bytes(x["kept"])) for x in suffix_dedup.remove_repeats(df).collect()}
    size = len(lines.encode())
    assert kept[1] == (size, b"") and kept[3] == (size, b"\nend")
    assert kept[0] == (0, texts[0].encode()) and kept[2] == (0, texts[2].encode())
    out = {(x["doc_id"], x["n_lines"], x["n_removed"], x["text"]) for x in line_dedup.remove_boilerplate(df, min_sites=2).collect()}
    assert out == set(brute_lines(rows, 2))
