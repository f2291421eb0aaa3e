"""Array kernels, codecs and planners without Spark."""

import random
import re
from datetime import date

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import lm, media, packing, pseudonyms, sharding, text, webp


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_shingles_equal_plain_python():
    r = random.Random(1)
    texts = [None, "", "  ", "One", "one two", "A b C d e", "é É \t x\ny"] + [" ".join(r.choice("ab cd é F g".split()) for _ in range(r.randrange(40))) for _ in range(60)] + ["w " * 700_000]
    for width in (1, 4, 5):
        known: dict = {}
        for t, got in zip(texts, text.shingle_sets(pa.array(texts), width), strict=True):
            ws = plain_words(t)
            want = {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()
            assert len(got) == len(want)
            for h in got.tolist():
                known.setdefault(h, set())
            assert known.setdefault(frozenset(got.tolist()), want) == want


def test_permuted_words_have_other_hashes():
    sets = list(text.shingle_sets(pa.array(["x y y x", "y x x y", "a b", "b a"]), 4))
    assert len({tuple(s.tolist()) for s in sets}) == 4


def images():
    r = np.random.default_rng(1)
    g = np.add.outer(np.arange(21), np.arange(33))
    yield np.stack([g % 256, g * 2 % 256, (g * 3 + 7) % 256, np.full_like(g, 255)], -1).astype(np.uint8)
    yield r.integers(0, 256, (13, 17, 4)).astype(np.uint8)
    yield r.integers(0, 3, (20, 18, 4)).astype(np.uint8) * np.uint8(80)
    yield np.zeros((1, 1, 4), np.uint8)
    yield np.tile(r.integers(0, 256, (5, 8, 4)), (9, 4, 1)).astype(np.uint8)


def test_every_tool_of_the_format_round_trips():
    modes = np.random.default_rng(2).integers(0, 14, (6, 9))
    T = webp.Tools
    for image in images():
        tools = [T(), T(subtract_green=True), T(copies=True), T(cache_bits=5), T(copies=True, cache_bits=9, meta_bits=3), T(meta_bits=2), T(factors=(7, -20, 100), block_bits=3)]
        tools += [T(modes=m, block_bits=3) for m in range(14)]
        own = modes[: (image.shape[0] + 3) // 4, : (image.shape[1] + 3) // 4]
        if own.shape == ((image.shape[0] + 3) // 4, (image.shape[1] + 3) // 4):
            tools.append(T(modes=own, block_bits=2, subtract_green=True, factors=(-3, 50, -128), copies=True, cache_bits=3, meta_bits=2))
        if len(np.unique(image.reshape(-1, 4), axis=0)) <= 256:
            tools += [T(palette=True), T(palette=True, copies=True, cache_bits=2)]
        for t in tools:
            assert (webp.decode_image(webp.encode_image(image, t)) == image).all(), t
    r = np.random.default_rng(3)
    for k in (1, 2, 3, 4, 5, 16, 17, 200):
        image = r.integers(0, 256, (k, 4)).astype(np.uint8)[r.integers(0, k, (9, 29))]
        assert (webp.decode_image(webp.encode_image(image, T(palette=True))) == image).all()


def test_a_known_file_is_decoded():
    # One pixel of a = 255, r = 1, g = 2, b = 3, written bit by bit: five codes of one symbol each.
    bits = "".join(f"{v:0{n}b}"[::-1] for v, n in [(0x2F, 8), (0, 14), (0, 14), (1, 1), (0, 3), (0, 1), (0, 1), (0, 1)])
    for symbol in (2, 1, 3, 255, 0):
        wide = symbol > 1
        bits += "1" + "0" + str(int(wide)) + f"{symbol:0{8 if wide else 1}b}"[::-1]
    data = int(bits[::-1], 2).to_bytes((len(bits) + 7) // 8, "little")
    assert next(webp.images_of(webp.file_of(data))).tolist() == [[[1, 2, 3, 255]]]


def bits_of(*numbers):
    """Numbers with their sizes, from the lowest bit on."""
    return "".join(f"{v:0{n}b}"[::-1] for v, n in numbers)


def one_symbol_codes(green, red, blue, alpha):
    """Five codes of one symbol each, so that a pixel takes no bits."""
    return "".join(bits_of((1, 1), (0, 1), (s > 1, 1), (s, 8 if s > 1 else 1)) for s in (green, red, blue, alpha, 0))


def flat_image(green, red, blue, alpha, main):
    return bits_of((0, 1)) + (bits_of((0, 1)) if main else "") + one_symbol_codes(green, red, blue, alpha)


def assembled(width, height, transforms, image):
    bits = bits_of((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)) + transforms + bits_of((0, 1)) + image
    data = int(bits[::-1], 2).to_bytes((len(bits) + 7) // 8, "little")
    return next(webp.images_of(webp.file_of(data))).tolist()


def test_assembled_files_of_each_transform():
    """Written bit by bit from the format's description, without the encoder; the pixels are worked out by hand."""
    got = assembled(3, 2, bits_of((1, 1), (0, 2), (0, 3)) + flat_image(2, 0, 0, 255, False), flat_image(2, 1, 3, 0, True))
    assert got == [[[1, 2, 3, 255], [2, 4, 6, 255], [3, 6, 9, 255]], [[2, 4, 6, 255], [3, 6, 9, 255], [4, 8, 12, 255]]]
    got = assembled(2, 2, bits_of((1, 1), (0, 2), (0, 3)) + flat_image(12, 0, 0, 255, False), flat_image(2, 1, 3, 0, True))
    assert got == [[[1, 2, 3, 255], [2, 4, 6, 255]], [[2, 4, 6, 255], [4, 8, 12, 255]]]
    got = assembled(2, 1, bits_of((1, 1), (1, 2), (0, 3)) + flat_image(8, 32, 16, 255, False), flat_image(64, 10, 20, 255, True))
    assert got == [[[42, 64, 78, 255]] * 2]
    assert assembled(1, 2, bits_of((1, 1), (2, 2)), flat_image(2, 254, 3, 9, True)) == [[[0, 2, 5, 9]]] * 2
    table = bits_of((0, 1)) + bits_of((1, 1), (1, 1), (1, 1), (20, 8), (1, 8)) + "".join(bits_of((1, 1), (1, 1), (1, 1), (a, 8), (b, 8)) for a, b in ((10, 1), (30, 2), (255, 0))) + bits_of((1, 1), (0, 1), (0, 1), (0, 1))
    # Of each code's two symbols the smaller has the bit 0: green 1 or 20, red 1 or 10, blue 2 or 30, alpha 0 or 255.
    table += "1111" + "0000"
    got = assembled(5, 1, bits_of((1, 1), (3, 2), (1, 8)) + table, flat_image(0b00010110, 0, 0, 255, True))
    first, second = [10, 20, 30, 255], [11, 21, 32, 255]
    assert got == [[first, second, second, first, second]]


def test_the_encoder_picks_what_pays():
    ramp = np.add.outer(np.arange(80) * 7, np.arange(64) * 3).astype(np.uint8)
    r = np.random.default_rng(4)
    noise = r.integers(0, 256, (64, 16)).astype(np.uint8)
    grey = np.stack([noise, noise, noise, r.integers(0, 256, (64, 16)).astype(np.uint8)], -1)
    half = np.stack([(noise.view(np.int8).astype(int) * 16 >> 5).astype(np.uint8), noise, noise * 0, noise * 0], -1)
    picked = [media.chosen_tools(x) for x in (ramp.reshape(80, 16, 4), grey, half)]
    assert picked[0].modes is not None and picked[1].subtract_green and picked[2].factors is not None
    text = media.chosen_tools(np.frombuffer(bytes(r.choice(list(b"etaoin shrdlu,."), 6400)), np.uint8).reshape(-1, 16, 4))
    assert text.modes is None and not text.subtract_green and text.factors is None
    for x in (ramp, grey, half, r.choice([0, 9, 200], (40, 64)), ramp[:3]):
        payload = x.astype(np.uint8).tobytes()
        stored = media.to_media(payload)
        assert b"".join(i.tobytes() for i in webp.images_of(stored)) == payload
    assert len(media.to_media(ramp.tobytes())) < 0.3 * ramp.size


def test_broken_files_are_refused():
    good = media.to_media(b"some text " * 30)
    for bad in (b"RIFF", good[:40], good[:20] + b"\xff" + good[21:], b"x" * 50, good + b"RI", good[:16] + b"\xff\xff\xff\xff" + good[20:]):
        with pytest.raises(webp.WebpError):
            list(webp.images_of(bad))


def test_changed_files_are_read_or_refused():
    """Any other exception fails the test. The size of the image, bytes 21 to 24, stays."""
    r = random.Random(13)
    images = [media.to_media(x) for x in (b"some text " * 30, bytes(range(256)) * 9, b"ab" * 400, bytes(r.randrange(256) for _ in range(900)))]
    refused = 0
    for _ in range(400):
        data = bytearray(r.choice(images))
        for _ in range(r.randrange(1, 4)):
            data[r.randrange(25, len(data))] = r.randrange(256)
        try:
            list(webp.images_of(bytes(data)))
        except webp.WebpError:
            refused += 1
    assert refused > 20


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 64, bytes(range(256)) * 5, b"Eaea " * 900, "é ñ".encode() * 400, b"ab" * 800_000])
def test_media_round_trip(payload):
    stored = media.to_media(payload)
    back = b"".join(i.tobytes() for i in webp.images_of(stored))
    size = max(64, -(-len(payload) // 64) * 64)
    assert back == payload.ljust(size, b"\0") and stored == media.to_media(payload)


def test_feistel_is_a_permutation():
    f = pseudonyms.Feistel(b"k")
    for n in (1, 2, 7, 100, 1000):
        image = [f.permute(x, n, "t") for x in range(n)]
        assert sorted(image) == list(range(n))
        assert [f.permute(y, n, "t", back=True) for y in image] == list(range(n))
    assert [f.permute(x, 1000, "a") for x in range(9)] != [f.permute(x, 1000, "b") for x in range(9)]


def test_pseudonyms_find_values_at_every_distance_from_a_number():
    u = pseudonyms.Pseudonyms("key")
    values = {"DE89 3704 0044 0532 0130 00": "iban", "+49 30 1234 5678": "phone", "4539 5787 6362 1486": "card", "jane.doe@example.org": "mail"}
    for value, kind in values.items():
        for gap in range(1, 140):
            for before in ("7" + " x" * (gap // 2) + " " * (gap % 2 + 1), "7" + "," * gap):
                got, spans = pseudonyms.pseudonymise_text(f"{before}{value}, 8", u)
                assert spans == [(len(before), len(before) + len(value), kind)] and value not in got, (value, gap)


def test_pseudonyms_beside_words_and_numbers():
    u = pseudonyms.Pseudonyms("key")
    spans = lambda t: pseudonyms.pseudonymise_text(t, u)[1]
    for iban in ("BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "LU28 0019 4006 4475 0000", "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00"):
        for after in (" a", " to", " for", " from", " for the", " 12", " 2021", " 4539 5787 6362 1486", ", for", " continuing"):
            for one in (iban, iban.replace(" ", "")):
                assert spans(one + after)[0] == (0, len(one), "iban"), one + after
    for card in ("4539 5787 6362 1486", "4539578763621486", "4539-5787-6362-1486", "3782 822463 10005"):
        for after in (" 12/25", " 12/2025", " 7", " 99 x", " 2021"):
            digits = re.sub(r"\D", "", card + after.split("/")[0])
            assert pseudonyms.luhn_valid(digits) or spans(card + after)[0] == (0, len(card), "card"), card + after
        for n in range(1000):
            t = f"{n} {card} 123"
            low = len(str(n)) + 1
            assert any(a <= low and low + len(card) <= b for a, b, _ in spans(t)), t
    both = "+49 30 1234 5678 4539 5787 6362 1486"
    assert spans(both) == [(0, 16, "phone"), (17, 36, "card")]
    assert spans("+49 30 1234 5678 9012 3456") and spans("DE88 3704 0044 0532 0130 00 for") == spans("4539 5787 6362 1487 x") == []


def test_pseudonyms_try_every_place():
    u = pseudonyms.Pseudonyms("key")
    r = random.Random(4)
    parts = ["BE68 5390 0754 7034", "+49 30 1234 5678", "4539 5787 6362 1486", "jane.doe@example.org", "7", "x", "12.5", "(030)", "2021-03-04", "1.2.3.4", "078-05-1120", "\u00e9", "a@b", "0123456789abcdef" * 2, "\n", "\u00a0", ",", "-", "word" * 30, "+", "@", ". "]
    for _ in range(400):
        t = "".join(r.choice(parts) + r.choice(["", " ", " "]) for _ in range(r.randrange(30)))
        want, at, broken = [], 0, 0
        for k in range(len(t)):
            if k >= at and (found := pseudonyms._chosen(t, k, u, broken)):
                want.append(found)
                at = found[1]
            elif k >= at:
                broken = max(broken, pseudonyms._broken_account(t, k))
        assert list(pseudonyms._values(t, u)) == want, t


def test_pseudonyms_of_all_countries_and_forms_of_dates():
    u = pseudonyms.Pseudonyms("key")
    hide = lambda t: pseudonyms.pseudonymise_text(t, u)
    for iban in (
        "CZ65 0800 0000 1920 0014 5399", "HU42 1177 3016 1111 1018 0000 0000", "RO49 AAAA 1B31 0075 9384 0000", "GR16 0110 1250 0000 0001 2300 695", "TR33 0006 1005 1978 6457 8413 26",
        "SA03 8000 0000 6080 1016 7519", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "AE07 0331 2345 6789 0123 456", "SK31 1200 0000 1987 4263 7541", "HR12 1001 0051 8630 0016 0", "BR18 0036 0305 0000 1000 9795 493C 1",
    ):
        for one in (iban, iban.replace(" ", "")):
            new, spans = hide(one + " and more")
            assert spans == [(0, len(one), "iban")] and pseudonyms._iban_rest(new[: len(one)].replace(" ", "")) == 1 and not new.startswith(one), one
    for t, size in [("3/4/2021", 8), ("13/4/2021", 9), ("1.12.1999.", 9), ("2021-3-4", 8), ("2021/3/14", 9), ("2021-03-04T10:00:00", 10), ("2021-03-04T10:00:00.5Z,", 10), ("2021-03-04t1000", 10)]:
        new, spans = hide(t)
        assert spans == [(0, size, "day")] and new[:size] != t[:size] and new[size:] == t[size:], t
        assert re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", t) and hide(t)[0] == new
    for t in ["31/4/2021", "2021-2-30", "2021-03-04Tee", "2021-03-045", "1.2.3", "1.2.2021.5", "0.1.2021", "3/4/21", "1-2-1850", "2021-03-04-05"]:
        assert hide(t) == (t, []), t
    for short in ("", "m", "d", "md"):
        days = pseudonyms._days(short)
        assert len({u.feistel.permute(k, len(days), "day" + short) for k in range(0, len(days), 7)}) == -(-len(days) // 7)
    made = [hide(f"{d}.{m}.{y}")[0] for y in (1999, 2000) for m in range(1, 10) for d in range(1, 10)]
    assert len(set(made)) == len(made) and {len(x) for x in made} == {8}


def test_pseudonyms_keep_formats():
    u = pseudonyms.Pseudonyms("key")
    hide = lambda t: pseudonyms.pseudonymise_text(t, u)
    for t, kind in [
        ("a 4539578763621486 b", "card"), ("4539 5787 6362 1486!", "card"), ("+1 (017) 555-7713,", "phone"), ("DE89 3704 0044 0532 0130 00", "iban"),
        ("born 1984-02-29.", "day"), ("31.12.1999", "day"), ("12/25/2001", "day"), ("192.168.1.254", "address"), ("x.55@mail4.example.com.", "mail"),
        ("078-05-1120", "social"), ('token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', "token"),
    ]:
        new, spans = hide(t)
        assert new != t and [s[2] for s in spans] == [kind] and len(new) == len(t)
        assert re.sub(r"[0-9a-fA-F]", "9", new) == re.sub(r"[0-9a-fA-F]", "9", t) or kind == "mail"
        assert hide(t)[0] == new and hide(f"{t} {t}")[0] == f"{new} {new}"
    assert pseudonyms.luhn_valid(re.sub(r"\D", "", hide("4539 5787 6362 1486")[0]))
    assert pseudonyms._iban_rest(hide("DE89 3704 0044 0532 0130 00")[0].replace(" ", "")) == 1
    assert date.fromisoformat(hide("1984-02-29")[0])
    assert hide("4539 5787 6362 1486")[0].replace(" ", "") == hide("4539578763621486")[0]
    for t in ["version 2.0 and 3.", "1234567890123456", "1999-02-30", "300.1.1.1", "DE89 3704 0044 0532 0130 01", "000-12-1234", "", "no digits @ all", "x" * 100_000 + " 7"]:
        assert hide(t) == (t, [])


def test_best_fit_plan_fills_bins():
    r = random.Random(6)
    for rule in ("norm", "dot"):
        for caps in (packing.Capacities(100, rule=rule), packing.Capacities(100, 4, None, rule=rule), packing.Capacities(100, 6, 5200, (1, 0.3, 0.5), rule)):
            counts = {n: r.randrange(1, 30) for n in r.sample(range(1, 73), 40)}
            rows, bins = packing.best_fit_plan(counts, caps)
            held: dict[int, list] = {}
            placed: dict[int, set] = {}
            for length, rank, n, first, offset in rows:
                for k in range(n):
                    held.setdefault(first + k, []).append((offset, length))
                    placed.setdefault(length, set()).add(rank + k)
            assert {n: set(range(c)) for n, c in counts.items()} == placed and len(held) == bins
            limit = caps.vector()
            for own in held.values():
                own.sort()
                assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
                assert (np.array([sum(n for _, n in own), len(own), sum(n * n for _, n in own)]) <= limit).all()
            if caps.documents is None:
                assert bins <= -(-sum(n * c for n, c in counts.items()) // 100) * 1.1 + 1
    with pytest.raises(ValueError):
        packing.best_fit_plan({101: 1}, packing.Capacities(100))


def plain_best_fit(counts, caps):
    """One piece after the other, the longest first, into the bin whose weighted remainder is the shortest."""
    full, weights, bins = caps.vector(), np.array(caps.weights), []
    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length], dtype=float)
        for _ in range(counts[length]):
            fits = [b for b in bins if (b >= item).all()]
            best = min(fits, key=lambda b: (weights * ((b - item) / full) ** 2).sum(), default=None)
            if best is None:
                bins.append(full - item)
            else:
                best -= item
    return len(bins)


def test_plan_needs_no_more_bins_than_plain_best_fit():
    r = random.Random(12)
    for caps in (packing.Capacities(100), packing.Capacities(100, 3), packing.Capacities(100, 8, 4000), packing.Capacities(100, 5, 3000, (1, 1, 1))):
        for _ in range(12):
            most = min(100, int((caps.attention or 10**4) ** 0.5))
            counts = {n: r.randrange(1, 12) for n in r.sample(range(1, most + 1), 25)}
            assert packing.best_fit_plan(counts, caps)[1] <= plain_best_fit(counts, caps) * 1.03 + 1, (caps, counts)


def test_cached_encoding_equals_the_whole_encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = packing.encoder(None)
    r = random.Random(7)
    letters = "abcXYZ  \n\t09'.,!*-éÉßñ÷×ªµ中\u0301\u00a0\u2028²½İ"
    texts = ["", "don't I'll 's", "É\u0301 e\u0301", "a\x1cb", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>É\u0301 <|ENDOFTEXT|> <|endoftext|", "The 2nd, THIS***"] + ["".join(r.choice(letters) for _ in range(60)) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_forward_and_backward_cuts_agree():
    r = random.Random(8)
    for _ in range(50):
        sizes = [r.randrange(1, 40) for _ in range(r.randrange(1, 30))]
        shards = r.randrange(1, 8)
        s = sharding.Segments(np.arange(len(sizes)), np.zeros(len(sizes), np.int64), np.array(sizes), np.ones(len(sizes), np.int64), max(sizes))

        def fits(c):
            n, left = 1, c
            for x in sizes:
                if x > left:
                    n, left = n + 1, c
                left -= x
            return n <= shards

        best = next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))
        assert sharding.forward(s, best, shards) is not None
        assert best == max(sizes) or sharding.forward(s, best - 1, shards) is None
        assert all(a <= b for a, b in zip(sharding.backward(s, best, shards), sharding.forward(s, best, shards), strict=True))


def test_mixture_weights_follow_the_better_estimate():
    b, q2, q1, n = np.array([3, 3, 7]), np.array([8, 16, 999]), np.array([80, 90, 24]), np.array([500, 400, 800])
    w = lm.mixture_weights(b, q2, q1, n, 1000)
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.9 and w[7, 1] > 0.9 and (w > 0).all()
