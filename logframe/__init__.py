"""Log hunting on Spark: predicates, pages, counts, top values, histograms and diffs."""

from logframe.functions.fields import field, flatten
from logframe.functions.guards import advise, looks_like_text
from logframe.functions.predicates import (
    all_of,
    any_of,
    between,
    day_range,
    exists,
    json_field,
    match_all,
    match_text,
    matching,
    none_of,
    phrase,
    term,
    time_range,
    wildcard,
)
from logframe.operators.aggregate import extended_stats, multi_terms, terms, value_diversity
from logframe.operators.anomaly import anomalous_terms, fan_out, outliers, pivot_values, spikes
from logframe.operators.chains import reachable
from logframe.operators.compare import compare, compare_fields
from logframe.operators.discover import discover_fields
from logframe.operators.explain import match_explain, text_score
from logframe.operators.histogram import auto_histogram, histogram
from logframe.operators.postings import search_postings, word_counts, write_postings
from logframe.operators.retrieve import count, search, search_after, search_total, walk
from logframe.operators.rollup import rolled_histogram, write_rollup
from logframe.operators.sketches import fan_out_of, fan_out_sketches, top_of, top_sketches
from logframe.operators.windows import in_windows
from logframe.plans.chain import Chain, chain
from logframe.plans.workflows import (
    added_samples,
    changed_drill,
    compare_report,
    investigate,
    top_offenders,
)
from logframe.session import build_session
from logframe.sources.catalog import (
    field_types,
    index_field_types,
    list_tables,
    list_time_fields,
    scan,
    scan_daily,
    table_layout,
    tables,
)

from logframe.sources.folders import new_folder
from logframe.sources.layout import (
    during,
    member_types,
    shredded,
    spike_rows,
    write_daily,
    write_shredded,
)
from logframe.sources.trigrams import files_like, index_trigrams, scan_like
from logframe.sources.zorder import write_zordered

__all__ = [name for name in dir() if not name.startswith("_")]
