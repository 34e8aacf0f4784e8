"""The contextual character transducer with lineage ("K" rules), as windows over characters.

Every condition of the first phase looks at original neighbours, so the phase is a projection over one window. The
collapse of Alefs, the deletions and the repair of word boundaries look at what is left by the step before, which is
a window over fewer rows of the same partitioning. Every source character keeps its row: ``out_id`` is the position
of the output character that it went into, null if it was deleted; ``rule`` and ``rule2``..``rule4`` say why.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.unicode import SPACE, is_arabic_letter, is_mark, is_space, strip_marks
from . import rules
from .segments import KEYS, characters, first_word, leading_space

ALEF, MADDAH, INVERTED_DAMMA, SMALL_MADDAH = "ا", 0x0653, 0x0657, 0x06E4


def _in(cp: Column, values: tuple[int, ...]) -> Column:
    return cp.isin(*values)


def with_context(segments: DataFrame) -> DataFrame:
    """Adds what the rules know of a whole segment: the bounds of an initial form, and whether a ligature is decoration."""
    text = F.coalesce(F.col("text"), F.lit(""))
    start, word = leading_space(text), first_word(text)
    formed = F.col("surah_start") & strip_marks(word).isin(*rules.INITIAL_FORMS)

    def decoration(at: Column) -> Column:
        """Whether the text without its ligature at this position holds the whole phrase."""
        rest = F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + 2, F.length(text)))
        letters = F.regexp_replace(rest, rf"[{SPACE}\p{{M}}]", "")
        return (F.substring(text, at + 1, F.lit(1)) == chr(rules.GUARDED_DELETE)) & reduce(lambda a, b: a | b, (letters.contains(s) for s in rules.BISMILLAH_SKELETONS))

    places = F.when(text.contains(chr(rules.GUARDED_DELETE)), F.filter(F.sequence(F.lit(0), F.length(text) - 1), decoration)).otherwise(F.array().cast("array<int>"))
    return segments.withColumns({
        "text": text,
        "form_from": F.when(formed, start).otherwise(F.lit(-1)),
        "form_to": F.when(formed, start + F.length(word)).otherwise(F.lit(-1)),
        "decorated": places,
    })


def stop_flags(chars: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds ``stop_length`` (2 or 3 where a stop sequence starts, else null), ``stop_class`` there, and ``stopped``.

    Rows may have ``positive`` and ``lexical``, what their run's properties say; a sequence is a proven stop sign if
    any of its characters is positive, lexical if all are, else unresolved. Without these columns all are lexical.
    """
    w = Window.partitionBy(*keys).orderBy("pos")
    ch, one, two = F.col("ch"), F.lead("ch", 1).over(w), F.lead("ch", 2).over(w)
    sequences = sorted(("".join(map(chr, s)) for s in rules.DELETE_SEQUENCES), key=len, reverse=True)
    length = F.coalesce(*(F.when((ch == s[0]) & (one == s[1]) & (two == s[2] if len(s) > 2 else F.lit(True)), F.lit(len(s))) for s in sequences))
    if "positive" not in chars.columns:
        flagged = chars.withColumn("stop_length", length)
        return flagged.withColumns({"stop_class": F.when(F.col("stop_length").isNotNull(), "lexical"), "stopped": F.lit(False)})

    def over(name: str, op: str) -> Column:
        a, b, c = (F.col(name) if k == 0 else F.lead(name, k).over(w) for k in range(3))
        pair = a | b if op == "or" else a & b
        return F.when(F.col("stop_length") == 2, pair).otherwise(pair | c if op == "or" else pair & c)

    flagged = chars.withColumn("stop_length", length)
    kind = F.when(over("positive", "or"), "proven_stop_sign").when(over("lexical", "and"), "lexical").otherwise("unresolved")
    flagged = flagged.withColumn("stop_class", F.when(F.col("stop_length").isNotNull(), kind))
    proven = F.col("stop_class") == "proven_stop_sign"
    flagged = flagged.withColumn("__reach", F.when(proven, F.col("stop_length")).otherwise(F.lit(0)))
    reach = [F.coalesce(F.col("__reach") if k == 0 else F.lag("__reach", k).over(w), F.lit(0)) > k for k in range(3)]
    return flagged.withColumn("stopped", reach[0] | reach[1] | reach[2]).drop("__reach")


def phase1(chars: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds rule, out1 (null if deleted) and introduced: contextual rules, then plain transforms of what they left."""
    w = Window.partitionBy(*keys).orderBy("pos")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    cp = F.ascii("ch")
    base = F.last(F.when(~is_mark(F.col("ch")), F.ascii("ch")), ignorenulls=True).over(past)
    after, before = F.ascii(F.lead("ch").over(w)), F.ascii(F.lag("ch").over(w))
    alef = ord(ALEF)
    in_form = (F.col("pos") >= F.col("form_from")) & (F.col("pos") < F.col("form_to"))
    named = chars.withColumns({"__base": base, "__after": after, "__before": before})
    rule = (
        F.when(F.col("stopped"), "E5_stop_sequence")
        .when((cp == rules.GUARDED_DELETE) & F.array_contains("decorated", F.col("pos")), "E6_decorative_bismillah")
        .when(cp == 0x06CC, "E2_Farsi_Yeh")
        .when(cp == 0x065E, "E1_Dammatan_anomaly")
        .when(cp == MADDAH, F.when(in_form, "C3_Muqattaat_strip_Maddah").when(_in(F.col("__base"), rules.LONG_VOWELS), "C2_long_vowel_strip_Maddah").when(F.col("__after") == alef, "C5_existing_Alef_strip_Maddah").otherwise("C5_nominal_Maddah_to_Alef"))
        .when(cp == INVERTED_DAMMA, F.when(F.col("__after") == alef, "C1_Inverted_Damma_plus_Alef").otherwise("C1_Inverted_Damma_nominal_Alef"))
        .when(cp == SMALL_MADDAH, "C6_small_high_Maddah_to_Alef")
        .when((cp == alef) & (F.col("__before") == INVERTED_DAMMA), "consumed")
    )
    plain = {k: v for k, v in rules.SIMPLE.items() if k not in rules.OVERRIDES}
    simple = F.create_map(*(F.lit(x) for k, v in plain.items() for x in (k, f"simple_U+{k:04X}_to_U+{v:04X}")))
    to = F.create_map(*(F.lit(x) for k, v in plain.items() for x in (k, chr(v))))
    named = named.withColumn("rule", F.coalesce(rule, F.when(_in(cp, tuple(plain)), simple[cp])))
    gone = F.col("rule").isin("E5_stop_sequence", "E6_decorative_bismillah", "C3_Muqattaat_strip_Maddah", "C2_long_vowel_strip_Maddah", "C5_existing_Alef_strip_Maddah", "consumed")
    out = (
        F.when(gone, F.lit(None)).when(F.col("rule") == "E2_Farsi_Yeh", chr(rules.OVERRIDES[0x06CC])).when(F.col("rule") == "E1_Dammatan_anomaly", chr(rules.OVERRIDES[0x065E]))
        .when(F.col("rule").startswith("simple_"), to[cp]).when(F.col("rule").isNotNull(), ALEF).otherwise(F.col("ch"))
    )
    return named.withColumns({"out1": out, "introduced": F.col("rule").isNotNull() & ~gone}).drop("__base", "__after", "__before")


def collapse(chars: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds out_id: the position of the character that stands for this one, null if deleted; and merged.

    In a run of Alefs numbered from 1, the first stays, as do those before the first introduced one; that one and all
    after it go into the one before it.
    """
    live = F.col("out1").isNotNull()
    w = Window.partitionBy(*keys).orderBy("pos")
    previous = F.last("out1", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = live & ((F.col("out1") != ALEF) | (F.coalesce(previous, F.lit("")) != ALEF))
    numbered = chars.withColumn("__run", F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # deleted rows count in no run; they stand between the rows of one without number
    order = Window.partitionBy(*keys, "__run").orderBy("pos")
    back, all_rows = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = numbered.withColumn("__i", F.sum(live.cast("int")).over(back))
    first = F.min(F.when(live & (F.col("out1") == ALEF) & F.col("introduced"), F.col("__i"))).over(all_rows)
    numbered = numbered.withColumn("__k", first)
    stays = live & ((F.col("__i") == 1) | F.col("__k").isNull() | (F.col("__i") < F.col("__k")))
    numbered = numbered.withColumn("__stays", stays)
    keeper = F.last(F.when(F.col("__stays"), F.col("pos")), ignorenulls=True).over(back)
    merged = live & ~F.col("__stays")
    numbered = numbered.withColumns({"out_id": F.when(live, keeper), "merged": merged})
    # an Alef that an Inverted Damma took along goes where the Damma went
    taken = F.when(F.col("rule") == "consumed", F.lag("out_id").over(w)).otherwise(F.col("out_id"))
    return numbered.withColumn("out_id", taken).drop("__run", "__i", "__k", "__stays")


def deletions(chars: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds rule3, separator and kept: deletions of what stands after the collapse."""
    w = Window.partitionBy(*keys).orderBy("pos")
    own = F.col("out_id") == F.col("pos")
    shown = F.when(own, F.col("out1"))
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    # what comes after is what came before in falling order; a frame that reaches to the end costs the square of the rows
    future = Window.partitionBy(*keys).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    # for each row that stands: the next one, its source place, and the letter on its own left, across marks
    following = F.last(F.when(own, F.struct(F.col("pos").alias("pos"), F.col("out1").alias("ch"))), ignorenulls=True).over(future)
    left = F.last(F.when(own & ~is_mark(F.col("out1")), F.col("out1")), ignorenulls=True).over(past)
    shaped = chars.withColumns({"__own": own, "__shown": shown, "__next": following, "__left": left})
    label = F.col("__next.ch").rlike(r"^\p{N}") & (F.col("__next.pos") == F.col("pos") + 1)
    space = F.coalesce((F.col("__shown") == "\u00a0") & label & is_arabic_letter(F.col("__left")), F.lit(False))
    number = F.col("__shown").rlike(r"^\p{N}")
    cp = F.ascii("__shown")
    rule = (
        F.when(space, "C8_numeric_label_NBSP_cleanup").when(number, "E3_numeric_category_delete").when(cp == 0xFDFA, "E4_U+FDFA_delete").when(cp == 0xFDFB, "E4_U+FDFB_delete")
        .when(cp.isin(*rules.EFFECTIVE_DELETE), F.concat(F.lit("delete_"), F.format_string("U+%04X", cp)))
    )
    shaped = shaped.withColumn("rule3", F.when(F.col("__own"), rule))
    cut = F.col("rule").isin("E5_stop_sequence", "E6_decorative_bismillah") | space | (F.col("rule3").isNotNull() & rules.is_separator(F.col("__shown")))
    kept = F.col("__own") & F.col("rule3").isNull()
    return shaped.withColumns({"separator": F.coalesce(cut, F.lit(False)), "kept": F.coalesce(kept, F.lit(False))}).drop("__own", "__shown", "__next", "__left")


def repairs(chars: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds repaired: whether a space is put in the place of this deleted separator.

    One space goes between two neighbours in the output whose words are Arabic on both sides, at the first of the
    separators that were deleted between them.
    """
    w = Window.partitionBy(*keys).orderBy("pos")
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    # what went into another character went into an Alef, and no Alef is deleted
    ranked = chars.withColumn("__lasts", F.col("kept") | F.coalesce(F.col("out_id") != F.col("pos"), F.lit(False)))
    ranked = ranked.withColumn("__rank", F.sum(F.col("kept").cast("int")).over(back))
    # a merged row is of the rank of the row it went into, which stands before it
    side = F.col("kept") & ~is_mark(F.col("out1"))
    letter = F.when(side, is_arabic_letter(F.col("out1")))
    ranked = ranked.withColumns({
        "__before": F.last(F.when(F.col("__lasts"), F.col("__rank")), ignorenulls=True).over(back),
        "__after": F.last(F.when(F.col("__lasts"), F.col("__rank")), ignorenulls=True).over(ahead),
        "__left": F.last(letter, ignorenulls=True).over(back),
        "__right": F.last(letter, ignorenulls=True).over(ahead),
    })
    gap = F.col("separator") & (F.col("__after") == F.col("__before") + 1) & F.col("__left") & F.col("__right")
    ranked = ranked.withColumn("__gap", F.coalesce(gap, F.lit(False)))
    first = F.min(F.when(F.col("__gap"), F.col("pos"))).over(Window.partitionBy(*keys, "__before"))
    repaired = F.col("__gap") & (first == F.col("pos"))
    return ranked.withColumn("repaired", F.coalesce(repaired, F.lit(False))).drop("__lasts", "__rank", "__before", "__after", "__left", "__right", "__gap")


def transduce(segments: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per source character with its lineage: ``keys``, pos, ch, rule, out1, introduced, out_id, merged, rule3,
    separator, kept, repaired, and stop_length and stop_class where a stop sequence starts.

    ``segments``: ``keys``, text, surah_start. A null text counts as empty, and has no rows.
    """
    chars = characters(with_context(segments), keys)
    return repairs(deletions(collapse(phase1(stop_flags(chars, keys), keys), keys), keys), keys).drop("form_from", "form_to", "decorated", "stopped", "surah_start")


def stretches(segments: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(``keys``, text, surah_start, n): segments cut at their plain spaces, and how many of each piece.

    No rule looks across a plain space: it stands, is no mark, letter, number, Alef or part of a stop sequence. What
    lies between two of them is therefore transduced the same alone. The first word of a segment that may open with
    an initial form stays with what is before it, and a segment with a ligature, which is told apart by its whole text,
    stays whole. Spaces that were cut are a row too, so that each character is in one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    start = F.coalesce(F.col("surah_start"), F.lit(False))
    head = F.regexp_extract(text, f"^[{SPACE}]*[^{SPACE}]*[^ ]*", 0)
    rest = F.when(F.length(head) < F.length(text), F.split(F.substring(text, F.length(head) + 2, F.length(text)), " ")).otherwise(F.array().cast("array<string>"))
    pieces = F.when(text.contains(chr(rules.GUARDED_DELETE)), F.array(text)).when(start, F.concat(F.array(head), rest)).otherwise(F.split(text, " "))
    rows = segments.select(*keys, start.alias("__start"), F.concat(pieces, F.array(F.lit(" "))).alias("__pieces"))
    rows = rows.select(*keys, "__start", (F.size("__pieces") - 1).alias("__size"), F.posexplode("__pieces").alias("__i", "text"))
    last = F.col("__i") == F.col("__size")
    out = rows.select(*keys, "text", (F.col("__start") & (F.col("__i") == 0)).alias("surah_start"), F.when(last, F.col("__size") - 1).otherwise(1).cast("bigint").alias("n"))
    return out.where("text <> '' AND n > 0")


#: Keys of stretches: their text, or a digest of a long one, which would else stand beside each of its characters.
STRETCH = ("stretch", "starts")


def by_stretch(pieces: DataFrame) -> DataFrame:
    """Stretches as segments of ``STRETCH``."""
    key = F.when(F.length("text") > 64, F.concat(F.lit("#"), F.sha2("text", 256))).otherwise(F.col("text"))
    return pieces.withColumns({"stretch": key, "starts": F.col("surah_start")})


def stretch_lineage(segments: DataFrame) -> DataFrame:
    """Lineage of all characters of ``segments`` by ``STRETCH``, equal stretches once, with their number ``n``."""
    pieces = stretches(segments).groupBy("text", "surah_start").agg(F.sum("n").alias("n"))
    return transduce(by_stretch(pieces), STRETCH)


def unlike(pairs: DataFrame) -> DataFrame:
    """The stretches (text, surah_start) of ``pairs`` (text, surah_start, output) whose output here is another one."""
    pieces = by_stretch(pairs.where("text <> ''").select("text", "surah_start", "output"))
    texts = output_text(transduce(by_stretch(pieces.select("text", "surah_start").distinct()), STRETCH), STRETCH).withColumnRenamed("text", "__own")
    return pieces.join(texts, list(STRETCH), "left").where(~F.col("output").eqNullSafe(F.col("__own"))).select("text", "surah_start").distinct()


def output_text(lineage: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``keys`` and text: what stands, in order, with the spaces put in. Segments of which nothing stands give ''."""
    piece = F.when(F.col("repaired"), " ").when(F.col("kept"), F.col("out1"))
    rows = lineage.select(*keys, F.struct("pos", piece.alias("ch")).alias("p"))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["ch"]), "").alias("text"))


def events(lineage: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per applied rule: ``keys``, pos, rule, phase, action, source, output."""
    e = lambda when, rule, phase, action, output: F.when(when, F.struct(rule.alias("rule"), F.lit(phase).alias("phase"), action.alias("action"), output.alias("output")))
    first = F.col("rule").isNotNull() & (F.col("rule") != "consumed") & ~((F.col("rule") == "E5_stop_sequence") & F.coalesce(F.col("stop_class") != "proven_stop_sign", F.lit(True)))
    simple = F.col("rule").startswith("simple_")
    action = F.when(F.col("rule").isin("E5_stop_sequence", "E6_decorative_bismillah"), "DELETE").otherwise("TRANSFORM")
    nbsp = F.col("rule3") == "C8_numeric_label_NBSP_cleanup"
    listed = F.array(
        e(first & ~simple, F.col("rule"), "phase1", action, F.coalesce("out1", F.lit(""))),
        e(first & simple, F.col("rule"), "phase2", F.lit("TRANSFORM"), F.col("out1")),
        e(F.col("merged"), F.lit("C6_new_duplicate_Alef_collapse"), "phase2", F.lit("COLLAPSE"), F.lit(ALEF)),
        e(F.col("rule3").isNotNull(), F.col("rule3"), "phase3", F.when(nbsp, "DELETE_BOUNDARY").otherwise("DELETE"), F.lit("")),
        e(F.col("repaired"), F.lit("C8_word_boundary_repair"), "phase4", F.lit("INSERT_BOUNDARY"), F.lit(" ")),
    )
    return lineage.select(*keys, "pos", F.col("ch").alias("source"), F.explode(F.filter(listed, lambda x: x.isNotNull())).alias("e")).select(*keys, "pos", "source", "e.*")


def decisions(lineage: DataFrame) -> DataFrame:
    """Applied rules and how often; stop sequences by class."""
    stops = lineage.where("stop_class IS NOT NULL").select(F.concat(F.lit("stop_sequence:"), F.col("stop_class")).alias("rule"))
    marks = lineage.where(F.col("rule") == "E6_decorative_bismillah").select(F.lit("bismillah:decorative_duplicate").alias("rule"))
    rest = events(lineage).where(~F.col("rule").isin("E5_stop_sequence", "E6_decorative_bismillah")).select("rule")
    return rest.unionAll(stops).unionAll(marks).groupBy("rule").agg(F.count("*").alias("n"))


def blockers(lineage: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """What strict mode refuses: unresolved stop sequences, and ligatures that are not proven decoration."""
    ligature = (F.ascii("ch") == rules.GUARDED_DELETE) & F.col("rule").isNull()
    kind = F.when(F.col("stop_class") == "unresolved", "unresolved_stop_sequence").when(ligature, "sole_or_unproven_bismillah_ligature")
    return lineage.withColumn("type", kind).where("type IS NOT NULL").select(*keys, "pos", "type")


def segment_report(lineage: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Counts of each segment: input_count, output_count, repairs, lineage_complete, unapproved_duplicate_alef."""
    w = Window.partitionBy(*keys).orderBy("pos")
    shown = F.when(F.col("repaired"), F.struct(F.lit(" ").alias("ch"), F.lit(True).alias("new"))).when(F.col("kept"), F.struct(F.col("out1").alias("ch"), (F.col("introduced") | F.col("took")).alias("new")))
    took = F.max(F.col("merged")).over(Window.partitionBy(*keys, "out_id"))
    rows = lineage.withColumn("took", F.coalesce(took, F.lit(False))).withColumn("shown", shown)
    previous = F.last("shown", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    twice = (F.col("shown.ch") == ALEF) & (previous["ch"] == ALEF) & (F.col("shown.new") | previous["new"])
    rows = rows.withColumn("twice", F.coalesce(twice, F.lit(False)))
    explained = F.col("kept") | F.col("merged") | F.col("rule").isNotNull() | F.col("rule3").isNotNull()
    return rows.groupBy(*keys).agg(
        F.count("*").alias("input_count"), F.count("shown").alias("output_count"),
        F.sum((F.col("repaired") | F.coalesce(F.col("rule3") == "C8_numeric_label_NBSP_cleanup", F.lit(False))).cast("int")).alias("word_boundary_repairs"),
        F.bool_and(F.coalesce(explained, F.lit(False))).alias("lineage_complete"), F.sum(F.col("twice").cast("int")).alias("unapproved_duplicate_alef"),
    )
