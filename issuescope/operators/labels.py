"""Labels: merging synonyms, translating, attaching, spreading into columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LABEL_DICTIONARY, NO_LABEL, SYNONYM_GROUPS
from ..functions.text import clean_text, label_key
from .lookup import HOT_ROWS, columns_of, dealt_lookup, free_name, literal_table, quoted, spread_lookup

#: Bytes of label names, with their ids, that go to the rows as one value; the names of a longer list are joined.
CARRIED_BYTES = 4 << 20
_ENTRY_BYTES = 16
#: Blocks of such a list.
_BLOCKS = 256


def synonym_table(spark: SparkSession, groups=SYNONYM_GROUPS) -> DataFrame:
    """(synonym, canonical, priority); a smaller priority wins."""
    rows = [
        (synonym, canonical, priority)
        for priority, (canonical, synonyms) in enumerate(groups, 1)
        for synonym in synonyms
    ]
    return literal_table(spark, rows, "synonym string, canonical string, priority int")


def dictionary_table(spark: SparkSession, pairs=LABEL_DICTIONARY) -> DataFrame:
    """(label, translation)."""
    return literal_table(spark, pairs, "label string, translation string")


def merge_labels(
    df: DataFrame,
    synonyms: DataFrame,
    base: str = "problem",
    ru: str | None = "problem_ru",
    output: str = "label",
    null_label: str | None = None,
) -> DataFrame:
    """Replace a label by the canonical label of its synonym group.

    Both the base and the translated label are looked up; the group of smaller priority wins, whichever of the
    two named it.  Without a match the base label stays as written.  ``null_label`` names rows without a base
    label; by default they stay null.  A label that very many rows share is spread, see ``dealt_lookup``.
    """
    best = synonyms.groupBy("synonym").agg(F.min(F.struct("priority", "canonical")).alias("match"))
    merged, matches = df, []
    for column in [c for c in (base, ru) if c]:
        name = free_name(merged, f"match_{column}")
        merged = dealt_lookup(merged, best, label_key(quoted(column)), name)
        matches.append(quoted(name))
    match = F.least(*matches) if len(matches) > 1 else matches[0]
    fallback = F.coalesce(quoted(base), F.lit(null_label)) if null_label is not None else quoted(base)
    return merged.select(*columns_of(df), F.coalesce(match.getField("canonical"), fallback).alias(output))


def translate_labels(
    df: DataFrame, dictionary: DataFrame, label: str = "problem", output: str = "problem_russ"
) -> DataFrame:
    """Look every label up in a dictionary, (label, translation) with a row per label; without an entry it gives null."""
    return dealt_lookup(df, dictionary.select("label", "translation"), quoted(label), output)


def parse_single_label(
    df: DataFrame, catalogue: DataFrame, answer: Column | str, output: str = "label"
) -> DataFrame:
    """A one-label answer -> the catalogue spelling of that label, or the "no label" mark.

    Labels that differ in case only share a key; the one with the smallest id is taken.  An answer that most rows share is
    spread, see ``dealt_lookup``.
    """
    from ..functions.answers import single_label_key

    labels = (
        catalogue.groupBy(F.lower("label").alias("key"))
        .agg(F.min(F.struct("label_id", "label")).getField("label").alias("found"))
        .filter(F.col("key") != NO_LABEL)
    )
    name = free_name(df, "label_found")
    named = dealt_lookup(df, labels, single_label_key(answer), name)
    return named.select(*columns_of(df), F.coalesce(quoted(name), F.lit(NO_LABEL)).alias(output))


def check_langs(langs: Sequence[str], at_most: int | None = None) -> list[str]:
    """The names without blanks; more than ``at_most`` of them is an error."""
    langs = [lang.strip() for lang in langs if lang.strip()]
    if at_most is not None and len(langs) > at_most:
        raise ValueError(f"at most {at_most} languages: {langs}")
    return langs


def _label_columns(names: Column, suffix: str) -> list[Column]:
    return [
        F.array_join(names, "|").alias(f"problem_{suffix}_candidates"),
        F.coalesce(F.get(names, F.lit(0)), F.lit("")).alias(f"problem_{suffix}"),
    ]


def named_labels(catalogue: DataFrame, translations: DataFrame | None = None, langs: Sequence[str] = ()) -> DataFrame:
    """(label_id, russ, <langs>): the names of every label.  A repeated id ends the job, as answers could mean either.

    Of several translations of a label into a language the smallest counts.
    """
    repeated = F.raise_error(F.concat(F.lit("repeated label id "), F.col("label_id").cast("string")))
    labels = catalogue.groupBy("label_id").agg(F.count(F.lit(1)).alias("_n"), F.min("label").alias("_label"))
    labels = labels.select(
        "label_id", F.when(F.col("_n") > 1, repeated.cast("string")).otherwise(F.col("_label")).alias("_name_russ")
    )
    if not langs:
        return labels
    words = translations.filter(F.col("lang").isin(*langs)).groupBy(F.col("label").alias("_name_russ"))
    words = words.agg(*[F.min(F.when(F.col("lang") == x, F.col("translation"))).alias(f"_name_{x}") for x in langs])
    return labels.join(words, "_name_russ", "left")


def _names_bytes(catalogue: DataFrame, translations: DataFrame | None, langs: Sequence[str]) -> int:
    sizes = catalogue.select(F.octet_length("label").alias("n"))
    if langs:
        sizes = sizes.unionAll(translations.filter(F.col("lang").isin(*langs)).select(F.octet_length("translation")))
    return sizes.agg(F.sum(F.coalesce("n", F.lit(0)) + _ENTRY_BYTES)).head()[0] or 0


def _carried_labels(df: DataFrame, ids: str, named: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """``df`` and a column per suffix with the names of its ids in order, read from one value of the plan.

    The value is a map of blocks of ids to maps of ids, so that a lookup passes few entries of a long list.
    """
    names = F.struct(*[F.col(f"_name_{s}").alias(s) for s in suffixes])
    number = F.col("label_id").cast("bigint")
    entries = named.filter("label_id IS NOT NULL").select(number.alias("id"), names.alias("names"))
    blocks = entries.groupBy(F.pmod("id", F.lit(_BLOCKS)).alias("block"))
    blocks = blocks.agg(F.map_from_entries(F.collect_list(F.struct("id", "names"))).alias("names"))
    whole = blocks.agg(F.map_from_entries(F.collect_list(F.struct("block", "names"))).alias("names")).scalar()
    carried, found = free_name(df, "label_names"), free_name(df, "labels_found")

    def names_of(i: Column) -> Column:
        i = i.cast("bigint")
        return F.try_element_at(F.try_element_at(quoted(carried), F.pmod(i, F.lit(_BLOCKS))), i)

    rows = df.select(*columns_of(df), whole.alias(carried))
    rows = rows.select(*columns_of(df), F.transform(F.col(ids), names_of).alias(found))

    def in_order(suffix: str) -> Column:
        named_so = F.filter(F.transform(quoted(found), lambda x: x.getField(suffix)), lambda x: x != "")
        return named_so.alias(f"_names_{suffix}")

    return rows.select(*columns_of(df), *[in_order(s) for s in suffixes])


def _joined_labels(
    df: DataFrame, ids: str, named: DataFrame, suffixes: Sequence[str], row_id: str | None, hot_rows: int
) -> DataFrame:
    """The same for a list of any length: every distinct list of ids is resolved once and looked up per row."""
    lists = df.groupBy(F.col(ids).alias("_ids")).agg(F.count(F.lit(1)).alias("_rows")).filter("_ids IS NOT NULL")
    single = lists.select("_ids", "_rows", F.posexplode_outer("_ids").alias("_pos", "label_id"))
    single = single.join(named, "label_id", "left")

    def in_order(suffix: str) -> Column:
        name = F.col(f"_name_{suffix}")
        pairs = F.collect_list(F.when(F.coalesce(name, F.lit("")) != "", F.struct("_pos", name.alias("name"))))
        return F.transform(F.array_sort(pairs), lambda p: p["name"]).alias(f"_names_{suffix}")

    found = single.groupBy("_ids", "_rows").agg(*[in_order(s) for s in suffixes])
    rows = df if row_id else df.withColumn("_number", F.monotonically_increasing_id())
    return spread_lookup(rows.withColumn("_ids", F.col(ids)), found, "_ids", row_id or "_number", "_rows", hot_rows)


def attach_labels(
    df: DataFrame,
    catalogue: DataFrame,
    ids: str = "label_ids",
    translations: DataFrame | None = None,
    langs: Sequence[str] = (),
    row_id: str | None = None,
    hot_rows: int = HOT_ROWS,
    carried_bytes: int = CARRIED_BYTES,
) -> DataFrame:
    """Label ids -> ``problem_russ``, ``problem_russ_candidates`` and the same two columns per language.

    Order and repetitions of the ids are kept, unknown ids dropped.  A translation that is empty or missing
    leaves no gap, so the first label in a language need not be the translation of the first Russian label.

    The names of a list of up to ``carried_bytes``, which is measured first, go to the rows as one value of the plan, and
    no row is shuffled.  Of a longer list every distinct list of ids is resolved once, by a join with the label list,
    and looked up per row; a list that very many rows share is spread.  ``row_id`` names a column that tells rows
    apart there; without it rows are numbered as they come.  ``translations`` has (label, lang, translation).
    """
    langs = check_langs(langs)
    if langs and translations is None:
        raise ValueError("languages need a translations table")
    suffixes = ["russ", *langs]
    named = named_labels(catalogue, translations, langs)
    if _names_bytes(catalogue, translations, langs) <= carried_bytes:
        joined = _carried_labels(df, ids, named, suffixes)
    else:
        joined = _joined_labels(df, ids, named, suffixes, row_id, hot_rows)
    empty = F.array().cast("array<string>")
    columns = [c for s in suffixes for c in _label_columns(F.coalesce(F.col(f"_names_{s}"), empty), s)]
    return joined.select(*columns_of(df), *columns)


def observed_labels(df: DataFrame, candidates: str) -> DataFrame:
    """The distinct labels found in a ``|``-joined column."""
    single = df.select(F.explode(F.split(candidates, r"\|")).alias("label"))
    return single.filter("label <> ''").distinct()


def seen_labels(df: DataFrame, langs: Sequence[str]) -> dict[str, list[str]]:
    """The sorted labels found per language, in one pass over the data.

    They become columns, so their number is bounded by what a table can have; they are collected for that.
    """

    def labels_of(lang: str) -> Column:
        names = F.split(F.coalesce(F.col(f"problem_{lang}_candidates"), F.lit("")), r"\|")
        return F.transform(names, lambda x: F.struct(F.lit(lang).alias("lang"), x.alias("label")))

    per_row = F.concat(*[labels_of(lang) for lang in langs])
    pairs = df.select(F.explode(per_row).alias("p")).select("p.lang", "p.label").filter("label <> ''").distinct()
    found: dict[str, list[str]] = {lang: [] for lang in langs}
    for r in pairs.collect():
        found[r.lang].append(r.label)
    return {lang: sorted(labels) for lang, labels in found.items()}


def add_wide_columns(
    df: DataFrame,
    labels: Sequence[str],
    langs: Sequence[str] = (),
    candidates: str = "problem_russ_candidates",
    observed: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One boolean column per label: ``ru_<label>`` for the whole catalogue, ``<lang>_<label>`` for labels seen.

    ``observed`` gives the labels per language when they are known; otherwise they are looked up, which reads
    the data once.  All columns come from one projection.
    """
    sources = [("ru", candidates, list(dict.fromkeys(labels)))]
    missing = [lang for lang in langs if lang not in (observed or {})]
    seen = seen_labels(df, missing) if missing else {}
    for lang in langs:
        names = seen[lang] if lang in seen else sorted(set(observed[lang]))
        sources.append((lang, f"problem_{lang}_candidates", names))
    split = df.select("*", *[F.split(c, r"\|").alias(f"_set_{p}") for p, c, _ in sources])
    flags = [
        F.coalesce(F.array_contains(f"_set_{prefix}", F.lit(label)), F.lit(False)).alias(f"{prefix}_{label}")
        for prefix, _, names in sources
        for label in names
    ]
    return split.select(*columns_of(df), *flags)


def label_flags(df: DataFrame, row_id: str = "row_id", langs: Sequence[str] = ()) -> DataFrame:
    """(row_id, prefix, label): one row per label of a message, the long form of ``add_wide_columns``.

    ``prefix`` is ``ru`` or the language.  One pass over the rows, and no shuffle, as a message's labels are told apart
    where they lie.
    """

    def labels_of(prefix: str, candidates: str) -> Column:
        names = F.array_distinct(F.filter(F.split(quoted(candidates), r"\|"), lambda x: x != ""))
        return F.transform(names, lambda x: F.struct(F.lit(prefix).alias("prefix"), x.alias("label")))

    sources = [("ru", "problem_russ_candidates"), *[(lang, f"problem_{lang}_candidates") for lang in langs]]
    empty = F.array().cast("array<struct<prefix:string,label:string>>")
    per_row = F.concat(*[F.coalesce(labels_of(p, c), empty) for p, c in sources])
    return df.select(quoted(row_id).alias(row_id), F.explode(per_row).alias("flag")).select(row_id, "flag.*")


def label_vocabulary(flags: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """(prefix, label, column): the columns of a sparse one-hot table, numbered from 0.

    The labels of ``catalogue`` come first, in the order of their ids and whether found or not; then the labels found per
    language, in the order of their names.  The numbers come from counts per block of names, so that a list of any
    length is numbered without passing one task.
    """
    from .first import with_rank

    named = flags.select("prefix", "label").distinct()
    first = None
    if catalogue is not None:
        first = catalogue.groupBy("label").agg(F.min("label_id").cast("bigint").alias("first_row_id"))
        first = first.select(F.lit("ru").alias("prefix"), "label", F.lit(2).alias("count"), "first_row_id")
        named = named.filter("prefix <> 'ru'")
    # Ranked by count descending, then place, then name: the catalogue before all others, these by a prefix of the name.
    place = F.conv(F.left(F.rpad(F.hex(F.concat("prefix", F.lit("\0"), "label")), 14, "0"), F.lit(14)), 16, 10).cast("bigint")
    others = named.select("prefix", "label", F.lit(1).alias("count"), place.alias("first_row_id"))
    all_ = others if first is None else first.unionByName(others)
    name = F.concat("prefix", F.lit("\0"), "label")
    ranked = with_rank(all_.withColumn("name", name), label="name", rank="column")
    return ranked.select("prefix", "label", (F.col("column") - 1).alias("column"))


def sparse_labels(flags: DataFrame, vocabulary: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row_id, columns): the sorted numbers of the true columns of every row that has one.

    Works for lists of any length, where a table cannot have a column per label.
    """
    numbered = flags.join(vocabulary, ["prefix", "label"])
    return numbered.groupBy(row_id).agg(F.array_sort(F.collect_list("column")).alias("columns"))


def numbered_block(catalogue: DataFrame, name: str = "label", order: str = "label_id") -> DataFrame:
    """The catalogue as one text with one entry per line, numbered by ``order``; entries without text keep their line.

    One text is the operator's result, so one task holds it; it is as long as what is put into a request.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(order), F.coalesce(F.col(name), F.lit("")).alias("name"))))
    lines = F.transform(entries, lambda e: F.concat(e.getField(order).cast("string"), F.lit(". "), e.getField("name")))
    return catalogue.agg(F.array_join(lines, "\n").alias("block"))


def parse_translations(answers: DataFrame, catalogue: DataFrame, langs: Sequence[str], answer: str = "content"):
    """A translation answer -> (label, lang, translation).

    The n-th entry of a language belongs to the n-th label in the order of the ids; for a label listed twice the later
    one counts.  See ``translation_fault`` for answers that cannot be used.
    """
    single = (
        answers.select(F.explode(_translations(answer)).alias("lang", "_entries"))
        .filter(F.col("lang").isin(*check_langs(langs)))
        .select("lang", F.posexplode("_entries").alias("_pos", "_entry"))
    )
    entries = F.array_sort(F.collect_list(F.struct("label_id", "label")))
    places = catalogue.agg(entries.alias("_labels")).select(F.posexplode("_labels").alias("_pos", "_label"))
    joined = single.join(places.select("_pos", F.col("_label.label").alias("label")), "_pos")
    return joined.groupBy("label", "lang").agg(F.max_by(clean_text("_entry"), "_pos").alias("translation"))


def _translations(answer: str) -> Column:
    from ..functions.text import strip_fence

    return F.from_json(strip_fence(answer), "translations map<string, array<string>>").getField("translations")


def translation_fault(answers: DataFrame, answer: str = "content") -> str | None:
    """Why a translation answer cannot be used: the call failed, or it is not the JSON that was asked for."""
    checked = answers.select("error", F.left(F.col(answer), F.lit(200)).alias("said"), _translations(answer).alias("found"))
    fault = checked.filter("error IS NOT NULL OR found IS NULL").head()
    return None if fault is None else fault.error or f"malformed answer: {fault.said!r}"
