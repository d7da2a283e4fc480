"""Label, count and report large tables of messages with PySpark."""

from .operators.blocks import filter_blocks, parse_blocks, quote_spans, split_paragraphs
from .operators.classify import classify_messages, distinct_texts, lexicon_classify, memo_rows, split_by_memo
from .operators.completions import (
    CallSettings,
    Prompt,
    answer_table,
    classify_requests,
    edit_requests,
    run_completions,
    section_requests,
    section_title,
    sections_from_answers,
    translate_requests,
)
from .operators.first import dedup_first, first_n_per_key, first_non_null, first_row_value, with_rank
from .operators.groups import (
    assemble_groups,
    corpus_summary,
    distribution,
    frequent_labels,
    group_rows,
    groups_of,
    keep_frequent,
    label_summary,
    labels_by_lang,
    ranked_labels,
    summary_facts,
    summary_of,
    top_links,
    top_messages,
)
from .operators.labels import (
    add_wide_columns,
    attach_labels,
    dictionary_table,
    label_flags,
    label_vocabulary,
    merge_labels,
    numbered_block,
    observed_labels,
    parse_single_label,
    parse_translations,
    sparse_labels,
    synonym_table,
    translate_labels,
)
from .operators.lookup import lookup_or_self
from .operators.report import build_report, country_display, description_block, section_blocks, toc
from .operators.usage import cost_estimate, price_table, usage_summary
from .plans.jobs import (
    classify_job,
    load_messages,
    noted_report_job,
    report_job,
    single_label_job,
    translate_catalogue,
)
from .session import build_session, spread_small, stage_table, work_dir
from .sources.catalogue import catalogue_table, read_catalogue
from .sources.memo import append_memo, compact_memo, memo_table, read_memo
from .sources.messages import read_messages
from .sources.roles import ColumnRoles, resolve_columns
from .sources.sinks import classified_path, write_classified, write_distribution, write_report
