r"""Quality rules on how public vocabularies take to a text.

Three figures of each text under each vocabulary: characters per token, the share of tokens that are
lone bytes (a byte fallback, or part of a character) and the entropy of the tokens against the most
that as many tokens could have. A band of each, per language and length else per script, says what
is ordinary; a text outside any of its bands is rejected. ``fit_bands`` measures bands on all clean
texts; ``fitted_rules`` encodes every text once, for its bands and its verdict. Texts that fail plain word
counts are rejected before.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import SPACED, Words, covered, extend, hash_spans, line_spans, seen_before, spans_in, text_bytes, written
from strataflow.llm.pieces import load_pieces
from strataflow.llm.samples import labelled_ids
from strataflow.llm.sequences import load_encoder

#: Script by the first byte of each character's UTF-8: ASCII letters and U+0080-U+036F, Greek,
#: Cyrillic, other two-byte scripts, U+0800-U+FFFF, beyond.
SCRIPTS = ("latin", "greek", "cyrillic", "other", "wide", "astral")
_script = np.full(256, -1, np.int8)
_script[65:91] = _script[97:123] = 0
_script[0xC2:0xCE] = 0
_script[0xCE:0xD0] = 1
_script[0xD0:0xD4] = 2
_script[0xD4:0xE0] = 3
_script[0xE0:0xF0] = 4
_script[0xF0:] = 5

#: Texts of fewer than 150, of fewer than 400, and of more tokens have bands of their own: the figures
#: of clean texts spread the less the longer they are.
SIZES = (150, 400)
#: Least entropy is of texts of up to this many tokens; of longer ones as many bits are asked for, not as great a share.
FULL = 4096
_short = ((1.607, 2.932), (0.0, 0.0643), (0.794, 1.0))

#: (least, most) of characters per token, byte share and relative entropy, for each size: the 0.5 and
#: 99.5 percentiles under piece_bpe_32k of the clean labelled texts of sf0.1 that pass the base, rows
#: held out of fits left out. Short texts of all languages are taken together. No byte at all, and no
#: token twice, are what good short texts reach, so those ends stay open.
LANGUAGES = {
    "de": (_short, ((2.432, 2.747), (0.0, 0.0250), (0.726, 1.0)), ((2.519, 2.721), (0.0, 0.0184), (0.564, 1.0))),
    "en": (_short, ((2.394, 2.795), (0.0, 0.0315), (0.729, 1.0)), ((2.476, 2.736), (0.0, 0.0196), (0.581, 1.0))),
    "es": (_short, ((2.136, 2.498), (0.0, 0.0238), (0.718, 1.0)), ((2.186, 2.406), (0.0, 0.0182), (0.567, 1.0))),
    "fr": (_short, ((2.021, 2.528), (0.0, 0.0302), (0.720, 1.0)), ((2.241, 2.463), (0.0, 0.0188), (0.554, 1.0))),
}

#: The same by script, for texts of no or another language, or in letters that their language isn't
#: written in. Latin holds the four languages' bands. The test tables have no clean text in the other
#: scripts to measure, so those are wide, and the same for every size.
BANDS = {
    **LANGUAGES,
    "latin": (_short, ((2.021, 2.795), (0.0, 0.0315), (0.718, 1.0)), ((2.186, 2.736), (0.0, 0.0196), (0.554, 1.0))),
    "greek": (((0.6, 6.0), (0.0, 0.60), (0.30, 1.0)),) * 3,
    "cyrillic": (((0.8, 8.0), (0.0, 0.40), (0.35, 1.0)),) * 3,
    "other": (((0.3, 6.0), (0.0, 0.95), (0.30, 1.0)),) * 3,
    "wide": (((0.3, 4.0), (0.0, 0.95), (0.30, 1.0)),) * 3,
    "astral": (((0.2, 4.0), (0.0, 1.0), (0.20, 1.0)),) * 3,
}


#: Ends of bands for which there is nothing measured: under any vocabulary most text is inside.
OPEN = ((0.1, 12.0), (0.0, 1.0), (0.2, 1.0))
#: Text bytes that are worked on at once: two vocabularies' tokens and their counts take many times as much.
SLICE = 1 << 19
FIGURES = ("chars_per_token", "byte_share", "token_entropy")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
JUDGED = ("base_failed", "kept", "script", "n_tokens")


def _named(paths: tuple[str, ...]) -> list[str]:
    """Columns of the figures: those of the vocabularies after the first have their number behind their names."""
    return [f"{name}{'' if not k else f'_{k + 1}'}" for k in range(len(paths)) for name in FIGURES]


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for, a fixed rule of the public format:
    printable Latin-1 stands for itself, the other bytes in order for U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)).difference(own)))}


@lru_cache(maxsize=4)
def _vocabulary(path: str):
    """(encoder, which ids are lone bytes): pieces that fall back to a byte, or tokens that are no whole characters."""
    if path.endswith(".model"):
        encoder = load_pieces(path)
        return encoder, encoder.fallback
    encoder, byte_of = load_encoder(path, 128 << 20), _letters()
    lone = np.zeros(len(encoder.opens), bool)
    for token, k in encoder.tokenizer.get_vocab().items():
        if encoder.plain and all(c in byte_of for c in token):
            try:
                bytes(byte_of[c] for c in token).decode()
            except UnicodeDecodeError:
                lone[k] = True
    return encoder, lone


def token_figures(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, byte share, relative entropy) of each text; 0, 0 and 1 where there are no tokens.

    Relative entropy: of the token distribution, over the logarithm of the number of tokens.
    """
    encoder, lone = _vocabulary(path)
    tokens, share, entropy = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.ones(len(texts))
    for k, packed in enumerate(encoder.packed(texts)):
        if packed:
            ids = np.frombuffer(packed, encoder.kind)
            tokens[k], share[k] = len(ids), lone[ids].sum() / len(ids)
            if len(ids) > 1:
                counts = np.bincount(ids)
                p = counts[counts > 0] / len(ids)
                entropy[k] = -(p * np.log(p)).sum() / np.log(len(ids))
    return tokens, share, entropy


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """Word and line counts of each text, and the number of characters by script."""
    data, offsets = text_bytes(column)
    words = Words(data, offsets, SPACED)
    n = len(offsets) - 1
    following = (data & 0xC0) == 0x80
    chars = np.diff(offsets) - spans_in(following, offsets)
    space = spans_in(~SPACED.member[data], offsets)
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    begins, ends, first = line_spans(data, offsets)
    full = np.searchsorted(words.begins, begins) < np.searchsorted(words.begins, ends)
    of_line = np.repeat(np.arange(n), np.diff(first))[full]
    again, _ = seen_before(hash_spans(data, begins[full], ends[full]), of_line)
    grams, room = words.grams(5)
    at = np.flatnonzero(room)
    _, twice = seen_before(grams[at], words.owners()[at])
    repeated = covered(len(grams), at[twice], 5)
    script = _script[data]
    return {
        "n_chars": chars,
        "n_words": words.counts,
        "word_chars": chars - space,
        "n_symbols": spans_in(symbol[data], offsets),
        "n_dup_lines": np.bincount(of_line[again], minlength=n),
        "n_repeat_words": np.diff(np.searchsorted(np.flatnonzero(repeated), words.first)),
        "scripts": np.stack([spans_in(script == k, offsets) for k in range(len(SCRIPTS))], 1) if n else np.zeros((0, len(SCRIPTS)), int),
    }


def _judged(column: pa.Array, paths: tuple[str, ...]) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts, base failed, script, tokens by vocabulary, figures: three for each vocabulary) of each text."""
    counts = base_counts(column)
    failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
    texts = [x or "" for x in column.to_pylist()]
    script = counts["scripts"].argmax(1) if len(texts) else np.zeros(0, int)
    tokens, figures = [], []
    for path in paths:
        n, share, entropy = token_figures(path, texts)
        tokens.append(n)
        figures += [counts["n_chars"] / np.maximum(n, 1), share, entropy]
    return counts, failed, script, np.stack(tokens, 1), np.stack(figures, 1)


def _needed(limit: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Bands of each text with its least entropy: of longer texts as many bits are asked for as of FULL tokens."""
    limit = limit.copy()
    limit[:, 2::3, 0] *= np.log(FULL) / np.log(np.maximum(tokens, FULL))
    return limit


def quality_rules(docs: DataFrame, vocabularies: str | tuple[str, ...], bands: dict[str, tuple] | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with counts, token figures, ``script`` and the verdicts ``base_failed`` and ``kept``.

    Counts are over the whole text. A text with fewer than 10 words, or with over 20 in 100 words in
    repeated five-word windows, fails the base; null and empty texts do. ``kept`` needs the base and
    every token figure, under every one of the ``vocabularies``, within the bands of the script most
    of whose letters the text has (Latin on a tie or without letters); of a Latin text whose ``lang``,
    if there is such a column, has bands, within that language's. ``bands``: by script or language, for
    each of three lengths (in tokens of the first vocabulary), the (least, most) of three figures for
    each vocabulary, as ``fit_bands`` gives them; BANDS if there is one vocabulary only. Figures of the
    vocabularies after the first have their number behind their names. Very long texts count whole,
    rows repeat as they are, columns with the added names are replaced, an empty table gives no rows.
    A narrow map, no shuffle.
    """
    paths = (vocabularies,) if isinstance(vocabularies, str) else tuple(vocabularies)
    if bands is None and len(paths) > 1:
        raise ValueError("several vocabularies need measured bands")
    bands = bands or BANDS
    languages = [x for x in bands if x not in SCRIPTS]
    limits = np.array([bands[x] for x in (*SCRIPTS, *languages)])
    row_of = {x: len(SCRIPTS) + k for k, x in enumerate(languages)}
    by_language = dict(docs.dtypes).get("lang") == "string"
    named = _named(paths)

    def judge(batch: pa.RecordBatch):
        counts, failed, script, tokens, figures = _judged(batch.column("text"), paths)
        band = script
        if by_language:
            language = np.array([row_of.get(x, 0) for x in batch.column("lang").to_pylist()], int)
            band = np.where(script == 0, language, script)
        limit = _needed(limits[band, np.searchsorted(SIZES, tokens[:, 0], "right")], tokens)
        inside = ((figures >= limit[:, :, 0]) & (figures <= limit[:, :, 1])).all(1)
        longs = {k: pa.array(counts[k], pa.int64()) for k in COUNTS}
        return longs | {
            "base_failed": pa.array(failed),
            "kept": pa.array(inside & ~failed),
            "script": pa.array([SCRIPTS[k] for k in script], pa.string()),
            "n_tokens": pa.array(tokens[:, 0]),
            **{name: pa.array(np.ascontiguousarray(figures[:, k])) for k, name in enumerate(named)},
        }

    added = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, script string, n_tokens bigint, "
    return extend(docs, judge, added + ", ".join(f"{name} double" for name in named), carry, limit=SLICE)


def _measured(docs: DataFrame, paths: tuple[str, ...], carry: list[str] | None) -> DataFrame:
    """``docs`` as ``quality_rules`` gives them, with ``_levels`` and ``_factors`` instead of the verdict.

    Levels: the figures, entropy as it would be of FULL tokens where there are more; factors: what a band's
    least entropy is multiplied by, for each vocabulary.
    """
    named = _named(paths)

    def measure(batch: pa.RecordBatch):
        counts, failed, script, tokens, figures = _judged(batch.column("text"), paths)
        long = np.log(np.maximum(tokens, FULL))
        levels = figures.copy()
        levels[:, 2::3] *= long / np.log(FULL)
        return {k: pa.array(counts[k], pa.int64()) for k in COUNTS} | {
            "base_failed": pa.array(failed),
            "script": pa.array([SCRIPTS[k] for k in script], pa.string()),
            "n_tokens": pa.array(tokens[:, 0]),
            **{name: pa.array(np.ascontiguousarray(figures[:, k])) for k, name in enumerate(named)},
            "_levels": pa.array(levels.tolist(), pa.list_(pa.float64())),
            "_factors": pa.array((np.log(FULL) / long).tolist(), pa.list_(pa.float64())),
        }

    added = [f"{k} bigint" for k in COUNTS] + ["base_failed boolean", "script string", "n_tokens bigint"] + [f"{name} double" for name in named] + ["_levels array<double>", "_factors array<double>"]
    return extend(docs.drop("kept"), measure, ", ".join(added), carry, limit=SLICE)


def _size() -> Column:
    return sum(((F.col("n_tokens") >= x).cast("int") for x in SIZES), F.lit(0))


def fitted_rules(docs: DataFrame, labels: DataFrame, vocabularies: tuple[str, ...], carry: list[str] | None = None) -> DataFrame:
    """``quality_rules`` by the bands that ``fit_bands`` measures on ``docs`` themselves, every text encoded once.

    ``docs`` with their figures are written to the shared folder (of their columns those that ``carry``
    names, all unless it is given), bands measured and verdicts given from there.
    """
    paths = tuple(vocabularies)
    by_language = dict(docs.dtypes).get("lang") == "string"
    needed = None if carry is None else [*carry, *(c for c in ("doc_id", *["lang"] * by_language) if c not in carry)]
    measured = written(_measured(docs, paths, needed), "token-figures")
    bands = _bands(measured, labels, paths)
    languages = [x for x in bands if x not in SCRIPTS]
    limits = [(x, k, [float(e[0]) for e in band], [float(e[1]) for e in band]) for x, sizes in bands.items() for k, band in enumerate(sizes)]
    table = docs.sparkSession.createDataFrame(limits, "_band string, _size int, _least array<double>, _most array<double>")
    name = F.when((F.col("script") == SCRIPTS[0]) & F.col("lang").isin(languages), F.col("lang")).otherwise(F.col("script")) if by_language else F.col("script")
    inside = ~F.col("base_failed")
    for k, figure in enumerate(_named(paths)):
        least = F.get("_least", F.lit(k))
        inside &= (F.col(figure) >= (least * F.get("_factors", F.lit(k // 3)) if k % 3 == 2 else least)) & (F.col(figure) <= F.get("_most", F.lit(k)))
    out = measured.withColumns({"_band": name, "_size": _size()}).join(F.broadcast(table), ["_band", "_size"], "left").withColumn("kept", inside)
    kept = [c for c in measured.columns if (carry is None or c in carry) and c in docs.columns and c not in (*COUNTS, *JUDGED, *_named(paths))]
    return out.select(*kept, *COUNTS, "base_failed", "kept", "script", "n_tokens", *_named(paths))


def fit_bands(docs: DataFrame, labels: DataFrame, vocabularies: tuple[str, ...], least: int = 80, lost: float = 0.01) -> dict[str, tuple]:
    """Bands by language and script under the ``vocabularies``, measured on all clean texts.

    Clean: labelled with quality 1, outside the held-out part, past the base. A language, or a script, and
    a length have bands of their own where there are ``least`` texts of them; else they have those of all
    Latin texts of that length, where those are enough, and open ends otherwise. Latin's own bands hold
    its languages'. Nulls, repeated rows and ids with both labels: as in ``train_quality``.
    """
    paths = tuple(vocabularies)
    columns = ["doc_id", "text", "lang"] if dict(docs.dtypes).get("lang") == "string" else ["doc_id", "text"]
    clean = docs.join(labelled_ids(labels, "quality", 1), "doc_id", "left_semi").select(*columns)
    return _bands(_measured(clean, paths, [c for c in columns if c != "text"]), labels, paths, least, lost)


#: Shares of texts beyond either end of a figure's band, the greatest first.
QUANTILES = (0.02, 0.015, 0.01, 0.0075, 0.005, 0.0025, 0.001, 0.0)


def _between(n: int) -> list[tuple[int, int, float]]:
    """Of n sorted values the two between which each lower and then each upper quantile lies, and how far from the first."""
    at = (n - 1) * np.array([*QUANTILES, *(1 - q for q in QUANTILES)])
    low = np.minimum(np.floor(at).astype(int), n - 1)
    return list(zip(low.tolist(), np.minimum(low + 1, n - 1).tolist(), (at - low).tolist()))


def _lerp(a: float, b: float, t: float) -> float:
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def _bands(measured: DataFrame, labels: DataFrame, paths: tuple[str, ...], least: int = 80, lost: float = 0.01) -> dict[str, tuple]:
    """What ``fit_bands`` gives, from figures.

    Both ends of a band stand at the same quantile of each figure, the innermost one that keeps all figures
    of all but ``lost`` of a group's texts between the ends, and give way by the spread over the root of
    the number of texts. Few lone bytes and much entropy are never a fault. Quantiles are exact: values are
    counted, ranked within group and figure, and those at the ranks asked for come to the driver.
    """
    spark, width = measured.sparkSession, 3 * len(paths)
    language = F.coalesce("lang", F.lit("")) if dict(measured.dtypes).get("lang") == "string" else F.lit("")
    clean = measured.where("not base_failed").join(labelled_ids(labels, "quality", 1), "doc_id", "left_semi")
    clean = clean.select(language.alias("lang"), "script", "n_tokens", "_levels").distinct()
    own = (F.col("script") == SCRIPTS[0]) & ~F.col("lang").isin("", *SCRIPTS)
    groups = F.when(own, F.array(F.lit(""), F.col("lang"))).otherwise(F.array(F.lit("")))
    rows = written(clean.select("script", F.explode(groups).alias("lang"), _size().alias("size"), "_levels"), "band-figures")
    key = ["script", "lang", "size"]
    counts = {tuple(r[:3]): r[3] for r in rows.groupBy(*key).count().where(F.col("count") >= least).collect()}
    ends: dict[tuple, np.ndarray] = {}
    if counts:
        wanted = [(*g, sorted({x for a, b, _ in _between(n) for x in (a, b)})) for g, n in counts.items()]
        wanted = F.broadcast(spark.createDataFrame(wanted, "script string, lang string, size int, ranks array<bigint>"))
        values = rows.select(*key, F.posexplode("_levels").alias("figure", "value")).groupBy(*key, "figure", "value").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*key, "figure").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        ranked = values.withColumn("upto", upto).join(wanted, key)
        ranked = ranked.select(*key, "figure", "value", F.explode(F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))).alias("rank"))
        found = {(r.script, r.lang, r.size, r.figure, r["rank"]): r.value for r in ranked.collect()}
        tried = {g: np.array([[_lerp(found[*g, f, a], found[*g, f, b], t) for f in range(width)] for a, b, t in _between(n)]) for g, n in counts.items()}
        limits = [(*g, k, t[k].tolist(), t[k + len(QUANTILES)].tolist()) for g, t in tried.items() for k in range(len(QUANTILES))]
        limits = F.broadcast(spark.createDataFrame(limits, "script string, lang string, size int, k int, low array<double>, high array<double>"))
        inside = F.lit(True)
        for f in range(width):
            inside &= F.get("_levels", F.lit(f)).between(F.get("low", F.lit(f)), F.get("high", F.lit(f)))
        held = {(r.script, r.lang, r.size, r.k): r.held for r in rows.join(limits, key).groupBy(*key, "k").agg(F.count_if(inside).alias("held")).collect()}
        for g, n in counts.items():
            k = next((k for k in range(len(QUANTILES)) if held[*g, k] / n >= 1 - lost), len(QUANTILES) - 1)
            low, high = tried[g][k], tried[g][k + len(QUANTILES)]
            slack = (high - low) / np.sqrt(n)
            ends[g] = np.stack([low - slack, high + slack], 1)
            ends[g][1::3, 0], ends[g][2::3, 1] = 0.0, 1.0
    sizes = range(len(SIZES) + 1)
    free = np.array(OPEN * len(paths), float)
    latin = [ends.get((SCRIPTS[0], "", k), free) for k in sizes]
    known = sorted({r.lang for r in rows.where("lang <> ''").select("lang").distinct().collect()})
    out = {x: [ends.get((SCRIPTS[0], x, k), latin[k]) for k in sizes] for x in known}
    every = [latin, *out.values()]
    out["latin"] = [np.stack([np.min([b[k][:, 0] for b in every], 0), np.max([b[k][:, 1] for b in every], 0)], 1) for k in sizes]
    out |= {x: [ends.get((x, "", k), free) for k in sizes] for x in SCRIPTS[1:]}
    return {x: tuple(tuple(map(tuple, b.tolist())) for b in found) for x, found in out.items()}
