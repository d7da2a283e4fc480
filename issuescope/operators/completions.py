"""Requests to a model, the calls, and their answers, all as tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    CLASSIFY_MAX_TOKENS,
    CLASSIFY_MODEL,
    FAILED_SECTION_TEXT,
    MAX_LABELS,
    MAX_MESSAGES,
    NO_LABEL,
    SECTION_MAX_TOKENS,
    SECTION_TEMPERATURE,
    SINGLE_LABEL_CHARS,
    SINGLE_LABEL_MAX_TOKENS,
    TRANSLATE_MAX_TOKENS,
    WRITER_MODEL,
)
from ..functions.text import bullet_list, clean_text, optional_suffix, render
from ..session import stage_table, work_dir
from .labels import check_langs, numbered_block
from .lookup import columns_of, free_name


#: Characters of a label list in a request.
LIST_CHARS = 1 << 20
#: Calls of a task between two commits to a ledger, and the folders of a ledger.
CALLS_PER_COMMIT = 500
LEDGER_BUCKETS = 64


@dataclass(frozen=True)
class Prompt:
    """System and user template; the names in braces are filled per request."""

    system: str
    user: str


TRANSLATE_PROMPT = Prompt(
    "Переведи названия проблем. Ответ — только JSON.",
    "Названия:\n{labels}\n\nЯзыки: {langs}\n\n"
    'Формат: {{"translations": {{"<язык>": ["перевод 1", "перевод 2"]}}}} в порядке списка.',
)
CLASSIFY_PROMPT = Prompt(
    "Определи, о каких проблемах из списка говорит текст. Ответ — только JSON.",
    "Текст:\n{text}\n\nПроблемы:\n{labels}\n{translations}\n\n"
    'Не более {max_labels} номеров, самые подходящие первыми: {{"problem_ids": [1, 2]}}',
)
SINGLE_LABEL_PROMPT = Prompt(
    f"Выбери одну метку из списка. Если ни одна не подходит, ответь «{NO_LABEL}».",
    "Метки: {labels}\n\nТекст:\n{text}",
)
SECTION_PROMPT = Prompt(
    "Ты пишешь раздел отчёта о проблемах жителей. Страна: {country}.",
    "Проблема: {title}\n\nВысказывания (до {max_messages}):\n{messages}\n{links}\n\n"
    "Части раздела: «Описание проблемы», «Пример 1», «Пример 2», «Цитаты», «Источники».",
)
EDIT_PROMPT = Prompt(
    "Ты редактируешь раздел отчёта. Сохрани его части и факты, убери повторы.",
    "Страна: {country}\n\nРаздел:\n{section}\n\nИсточники:\n{links}",
)


def _request(stage: str, model: str, prompt: Prompt, temperature: float, max_tokens: int, **values) -> list[Column]:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = F.btrim(render(prompt.user, **values), F.lit(" \n"))
    return [
        F.lit(stage).alias("stage"),
        F.lit(model).alias("model"),
        F.array(message("system", render(prompt.system, **values)), message("user", user)).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"),
    ]


def _part(text: DataFrame) -> Column:
    """The one text of a table as a part of every request: a scalar of the plan, which never comes to the driver.

    It is repeated in each request, so more than ``LIST_CHARS`` characters end the job.
    """
    (name,) = text.columns
    long = F.raise_error(F.concat(F.lit("a list too long for a request: "), F.char_length(name).cast("string")))
    return text.select(F.when(F.char_length(name) > LIST_CHARS, long.cast("string")).otherwise(F.col(name))).scalar()


def _block(catalogue: DataFrame, name: str = "label") -> Column:
    return _part(numbered_block(catalogue, name))


def label_line(catalogue: DataFrame, sep: str = ", ") -> Column:
    """The labels in the order of their ids as one text, which goes into every request."""
    entries = F.array_sort(F.collect_list(F.struct("label_id", "label")))
    return _part(catalogue.agg(F.array_join(F.transform(entries, lambda e: e.getField("label")), sep).alias("line")))


def translate_requests(
    catalogue: DataFrame,
    langs,
    prompt: Prompt = TRANSLATE_PROMPT,
    model: str = CLASSIFY_MODEL,
    temperature: float = 0.0,
    max_tokens: int = TRANSLATE_MAX_TOKENS,
) -> DataFrame:
    """One request for the translation of the whole catalogue."""
    block = numbered_block(catalogue)
    langs = check_langs(langs)
    return block.select(
        F.lit("translate").alias("request_id"),
        *_request(
            "translate", model, prompt, temperature, max_tokens, labels=F.col("block"), langs=", ".join(langs)
        ),
    )


def classify_requests(
    df: DataFrame,
    catalogue: DataFrame,
    text: str = "message",
    request_id: str = "row_id",
    translations: DataFrame | None = None,
    langs=(),
    max_labels: int = MAX_LABELS,
    single: bool = False,
    prompt: Prompt | None = None,
    model: str = CLASSIFY_MODEL,
    keep: tuple[str, ...] = (),
    max_chars: int | None = SINGLE_LABEL_CHARS,
    temperature: float = 0.0,
    max_tokens: int | None = None,
) -> DataFrame:
    """One request per row with text.

    The default asks for several labels by number and sends the whole text.  ``single`` asks for one label by
    name and sends the first ``max_chars`` characters of the text, as that question is defined; None sends it all.
    """
    kept = df.withColumn("_text", clean_text(text)).filter("_text <> ''")
    if single:
        names = label_line(catalogue)
        columns = _request(
            "classify",
            model,
            prompt or SINGLE_LABEL_PROMPT,
            temperature,
            max_tokens or SINGLE_LABEL_MAX_TOKENS,
            labels=names,
            text=F.col(text) if max_chars is None else F.substring(F.col(text), 1, max_chars),
        )
    else:
        blocks: list[Column] = [F.lit("")]
        for lang in check_langs(langs):
            words = translations.filter(F.col("lang") == lang).select("label", "translation")
            blocks += [F.lit(f"\n[{lang}]\n"), _block(catalogue.join(words, "label", "left"), "translation")]
        columns = _request(
            "classify",
            model,
            prompt or CLASSIFY_PROMPT,
            temperature,
            max_tokens or CLASSIFY_MAX_TOKENS,
            text=F.col("_text"),
            labels=_block(catalogue),
            translations=F.concat(*blocks),
            max_labels=str(max_labels),
        )
    return kept.select(F.col(request_id).alias("request_id"), *columns, *keep)


def prompt_title(label: Column, ru: Column) -> Column:
    return optional_suffix(label, ru, " / ")


def section_requests(
    groups: DataFrame,
    country: str,
    max_messages: int = MAX_MESSAGES,
    with_links: bool = False,
    prompt: Prompt = SECTION_PROMPT,
    model: str = WRITER_MODEL,
    temperature: float = SECTION_TEMPERATURE,
    max_tokens: int = SECTION_MAX_TOKENS,
) -> DataFrame:
    """One request per group for the text of its section."""
    messages = F.slice("messages", 1, max_messages)
    return groups.select(
        F.col("label").alias("request_id"),
        *_request(
            "generate",
            model,
            prompt,
            temperature,
            max_tokens,
            country=country,
            title=prompt_title(F.col("label"), F.col("problem_ru")),
            max_messages=str(max_messages),
            messages=bullet_list(messages, "\n\n"),
            links=bullet_list(F.col("links"), "\n") if with_links else "",
        ),
    )


def edit_requests(
    sections: DataFrame,
    country: str,
    section: str = "content",
    request_id: str = "label",
    links: str = "links",
    prompt: Prompt = EDIT_PROMPT,
    model: str = WRITER_MODEL,
    temperature: float = SECTION_TEMPERATURE,
    max_tokens: int = SECTION_MAX_TOKENS,
) -> DataFrame:
    """One request per written section for its edited text."""
    return sections.select(
        F.col(request_id).alias("request_id"),
        *_request(
            "edit",
            model,
            prompt,
            temperature,
            max_tokens,
            country=country,
            section=F.col(section),
            links=bullet_list(F.col(links), "\n"),
        ),
    )


@dataclass(frozen=True)
class CallSettings:
    """How a job asks its models.

    ``translate``, ``classify``, ``generate`` and ``edit`` hold arguments of the request functions of these stages:
    prompt, model, temperature, max_tokens.  ``rounds`` counts the attempts at a request that fails.  ``ledger`` names a
    folder where answers are kept as they come, so that a job started again pays only for what is missing; see
    ``answer_table``.
    """

    translate: dict = field(default_factory=dict)
    classify: dict = field(default_factory=dict)
    generate: dict = field(default_factory=dict)
    edit: dict = field(default_factory=dict)
    parallelism: int | None = None
    calls_per_task: int = 1
    rounds: int = 1
    ledger: str | None = None
    calls_per_commit: int = CALLS_PER_COMMIT

    @property
    def running(self) -> dict:
        return {
            "parallelism": self.parallelism,
            "calls_per_task": self.calls_per_task,
            "rounds": self.rounds,
            "ledger": self.ledger,
            "calls_per_commit": self.calls_per_commit,
        }


_ANSWER = T.StructType(
    [
        T.StructField("content", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
    ]
)

Completion = Callable[[str, list, float, int], "tuple[str, dict | None]"]

_LEDGER = "call_key string, content string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, bucket int"


def estimated_tokens() -> Column:
    """A request's tokens as far as they can be told before the call: a quarter of its characters, one at least."""
    chars = F.aggregate("messages", F.lit(0), lambda n, m: n + F.char_length(m["content"]))
    return F.greatest(F.lit(1), F.ceil(chars / 4)).cast("bigint")


def call_tasks(requests: DataFrame, tasks: int, tokens: Column | None = None) -> DataFrame:
    """Add ``call_task``, 0 to ``tasks`` - 1: ranges of requests with about the same sum of estimated tokens.

    Requests are put in the order of their id's MD5, which mixes long and short ones.  A task takes those whose running
    sum begins in its share of the total, so it has its share and one request more at most.  The running sum is made of
    sums per block of ids, of which there are ``_BLOCKS``, and within blocks; no task sees all requests.
    """
    order, block, size, before, share = (free_name(requests, n) for n in ("order", "block", "size", "before", "share"))
    digest = F.md5(F.col("request_id").cast("string"))
    sized = requests.withColumns({order: digest, size: estimated_tokens() if tokens is None else tokens})
    sized = sized.withColumn(block, F.conv(F.substring(order, 1, 3), 16, 10).cast("int"))
    unbounded = Window.unboundedPreceding
    blocks = sized.groupBy(block).agg(F.sum(size).alias(size))
    earlier = F.coalesce(F.sum(size).over(Window.orderBy(block).rowsBetween(unbounded, -1)), F.lit(0))
    total = F.sum(size).over(Window.partitionBy(F.lit(0)))
    # At most _BLOCKS short rows.
    starts = F.broadcast(blocks.select(block, earlier.alias(before), total.alias(share)))
    within = Window.partitionBy(block).orderBy(order, "request_id").rowsBetween(unbounded, -1)
    at = F.col(before) + F.coalesce(F.sum(size).over(within), F.lit(0))
    task = F.floor(at.cast("decimal(38,0)") * tasks / F.col(share)).cast("int")
    numbered = sized.join(starts, block).withColumn("call_task", F.least(task, F.lit(tasks - 1)))
    return numbered.select(*columns_of(requests), "call_task")


def run_completions(
    requests: DataFrame,
    complete: Completion,
    parallelism: int | None = None,
    keep: tuple[str, ...] = (),
    calls_per_task: int = 1,
) -> DataFrame:
    """Call ``complete(model, messages, temperature, max_tokens) -> (content, usage)`` for every request.

    Calls run in as many tasks as ``parallelism`` says, with about as many tokens each (``call_tasks``), and each task has ``calls_per_task`` of them under way at a
    time, as a call is mostly waiting; ``complete`` must then bear being called from several threads.  A call that raises gives a row with ``error``; the
    columns in ``keep`` are passed through.  The result is lazy: use ``answer_table`` where calls cost money.
    """
    passed = ["request_id", "stage", "model", *keep]
    sent = requests.select(*passed, *[c for c in ("messages", "temperature", "max_tokens") if c not in passed])
    schema = T.StructType([sent.schema[c] for c in passed] + _ANSWER.fields)
    names = [f.name for f in _ANSWER.fields]

    # Both functions travel to the workers whole, so the library itself need not be installed there.
    def ask(r) -> tuple:
        try:
            content, usage = complete(r.model, list(r.messages), float(r.temperature), int(r.max_tokens))
            usage = usage or {}
            asked, said = int(usage.get("prompt_tokens", 0)), int(usage.get("completion_tokens", 0))
            return content.strip(), None, asked, said, int(usage.get("total_tokens", asked + said))
        except Exception as error:  # one failed call must not end the job
            return None, str(error), 0, 0, 0

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if calls_per_task > 1:
                with ThreadPoolExecutor(calls_per_task) as pool:
                    answers = list(pool.map(ask, batch.itertuples(index=False)))
            else:
                answers = [ask(r) for r in batch.itertuples(index=False)]
            out = batch[passed].reset_index(drop=True)
            values = pd.DataFrame(answers, columns=names).astype(
                {"prompt_tokens": "int64", "completion_tokens": "int64", "total_tokens": "int64"}
            )
            yield pd.concat([out, values], axis=1)

    if parallelism:
        sent = call_tasks(sent, parallelism).repartitionById(parallelism, F.col("call_task")).drop("call_task")
    return sent.mapInPandas(call, schema)


def answer_table(
    requests: DataFrame,
    complete: Completion,
    parallelism: int | None = None,
    keep: tuple[str, ...] = (),
    rounds: int = 1,
    name: str = "answers",
    calls_per_task: int = 1,
    ledger: str | None = None,
    calls_per_commit: int = CALLS_PER_COMMIT,
) -> DataFrame:
    """Run the calls and write the answers once; requests that failed are asked again in further ``rounds``.

    ``requests`` should be a projection of a written table: a lost executor then repeats its own calls only.

    ``ledger`` is a folder of answers by request, whatever their ids.  Calls are made bucket by bucket of the requests'
    digests, and every bucket's answers are committed before the next one begins, so that a job that dies and is
    started again asks only what the ledger lacks.  There are as many steps as leave each task about
    ``calls_per_commit`` calls a step, up to ``LEDGER_BUCKETS``; what is lacking is written once by step, so that each
    step reads its own share.  Equal requests are asked once.  Calls that failed are not kept.
    """
    if ledger:
        return _ledger_answers(
            requests, complete, parallelism, keep, rounds, name, calls_per_task, ledger, calls_per_commit
        )
    answers = stage_table(run_completions(requests, complete, parallelism, keep, calls_per_task), name)
    for _ in range(rounds - 1):
        failed = answers.filter("error IS NOT NULL").select("request_id")
        if failed.isEmpty():
            break
        again = requests.join(failed, "request_id", "left_semi")
        retried = run_completions(again, complete, parallelism, keep, calls_per_task)
        answers = stage_table(answers.filter("error IS NULL").unionByName(retried), name)
    return answers


def call_key() -> Column:
    """The digest of all that decides about an answer."""
    asked = F.struct("model", "messages", "temperature", "max_tokens")
    return F.sha2(F.to_json(asked), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(call_key, content, tokens, bucket) of the answers kept at ``path``; empty when nothing is there."""
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _LEDGER)
        raise


def _ledger_answers(
    requests: DataFrame,
    complete: Completion,
    parallelism: int | None,
    keep: tuple[str, ...],
    rounds: int,
    name: str,
    calls_per_task: int,
    ledger: str,
    calls_per_commit: int,
) -> DataFrame:
    spark = requests.sparkSession
    number = F.conv(F.substring("call_key", 1, 4), 16, 10).cast("int") % LEDGER_BUCKETS
    keyed = requests.withColumn("call_key", call_key()).withColumn("bucket", number)
    passed = [c for c in dict.fromkeys(("request_id", "stage", "model", *keep))]
    # Written, as it is joined with the answers at the end and counted now.
    asked = stage_table(keyed.select(*passed, "call_key", "bucket"), f"{name}-asked")
    tasks = parallelism or spark.sparkContext.defaultParallelism
    missing = asked.join(read_ledger(spark, ledger), ["bucket", "call_key"], "left_anti").select("call_key").distinct()
    steps = min(LEDGER_BUCKETS, -(-missing.count() // (tasks * calls_per_commit)))
    failed = None
    if steps:
        # Every lacking request once, written by step, so that a step reads its own requests and shuffles none.
        sent = dict.fromkeys(("stage", "model", "messages", "temperature", "max_tokens", "call_key", "bucket"))
        todo = keyed.join(read_ledger(spark, ledger), ["bucket", "call_key"], "left_anti").select(*sent)
        todo = todo.dropDuplicates(["bucket", "call_key"]).withColumn("step", F.col("bucket") % steps)
        folder = f"{work_dir(spark)}/issuescope/{name}-todo-{uuid.uuid4().hex}"
        todo.write.partitionBy("step").parquet(folder)
        todo = spark.read.schema(todo.schema).parquet(folder)
    for step in range(steps):
        part = todo.filter(F.col("step") == step)
        for attempt in range(rounds):
            lacking = part
            if attempt:
                known = read_ledger(spark, ledger).filter(F.col("bucket") % steps == step)
                lacking = part.join(known, ["bucket", "call_key"], "left_anti")
            lacking = lacking.withColumn("request_id", F.col("call_key")).select(
                "request_id", "stage", "model", "messages", "temperature", "max_tokens", "call_key", "bucket"
            )
            answers = run_completions(lacking, complete, parallelism, ("call_key", "bucket"), calls_per_task)
            # One write holds both, so that no call is made twice; only what succeeded counts as known.
            said = answers.select(*[F.col(c.split()[0]) for c in _LEDGER.split(", ")], "error")
            folder = f"{work_dir(spark)}/issuescope/{name}-step-{uuid.uuid4().hex}"
            said.write.parquet(folder)
            written = spark.read.schema(said.schema).parquet(folder)
            good = written.filter("error IS NULL").drop("error")
            good.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(ledger)
            bad = written.filter("error IS NOT NULL").select("call_key", "error")
            if bad.isEmpty():
                bad = None
                break
        if bad is not None:
            failed = bad if failed is None else failed.unionByName(bad)
    found = read_ledger(spark, ledger).groupBy("bucket", "call_key").agg(
        F.min(F.struct("content", "prompt_tokens", "completion_tokens", "total_tokens")).alias("_said")
    )
    joined = asked.join(found, ["bucket", "call_key"], "left")
    if failed is None:
        joined = joined.withColumn("error", F.lit(None).cast("string"))
    else:
        joined = joined.join(failed, "call_key", "left")
    tokens = [F.coalesce(f"_said.{c}", F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    return stage_table(joined.select(*passed, "_said.content", "error", *tokens), name)


def sections_from_answers(groups: DataFrame, written: DataFrame, edited: DataFrame) -> DataFrame:
    """(label, rank, title, text, failed): one section per group, in order of rank.

    A group whose section could not be written or edited keeps its place with the error as its text.
    """
    drafts = written.select(F.col("request_id").alias("label"), F.col("error").alias("_draft_error"))
    finals = edited.select(
        F.col("request_id").alias("label"), F.col("content").alias("_text"), F.col("error").alias("_edit_error")
    )
    joined = groups.join(drafts, "label", "left").join(finals, "label", "left")
    error = F.coalesce("_draft_error", "_edit_error")
    plain = F.when(F.coalesce("problem_ru", F.lit("")) != "", F.col("problem_ru")).otherwise(F.col("label"))
    return joined.select(
        "label",
        "rank",
        F.when(error.isNotNull(), plain)
        .otherwise(section_title(F.col("problem_ru"), F.col("label")))
        .alias("title"),
        F.when(error.isNotNull(), F.concat(F.lit(FAILED_SECTION_TEXT), error))
        .otherwise(F.col("_text"))
        .alias("text"),
        error.isNotNull().alias("failed"),
    )


def section_title(ru: Column, label: Column) -> Column:
    """``ru (label)``, or the label alone when there is no other name."""
    named = (F.coalesce(ru, F.lit("")) != "") & (ru != label)
    return F.when(named, F.concat(ru, F.lit(" ("), label, F.lit(")"))).otherwise(label)
