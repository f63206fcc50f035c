"""Headline queries at one scale factor; prints one JSON line.

Each query runs once to warm up and then twice; the better time counts. Results go to a no-op
sink, so every column is computed and nothing is collected.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from talkweave.catalog import QUERIES  # noqa: E402
from talkweave.session import get_session  # noqa: E402

HEADLINE = """
read_messages read_story html_text drop_equal_columns backfill_pairs number_word remap drop_tail
sentences tokens split_multilabel conversation_runs history label_history prev_message
prev_categories check_pivot value_share counts_over_time_minute counts_by_category
length_histogram term_frequencies first_n_per_class tfidf_top tfidf_top_per_document row_mode
pairwise_kappa stratified_split attach_context pivot_predictions join_on_text exclude_examples
chunk_fixed chunk_recursive embed top_k embedding_sum build_prompts ensemble_prompt score
find_first vote classification_report label_mean_distances sampled_energy_distance
clean_messages prompt_report
""".split()


def main(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names or HEADLINE:
        best = None
        for turn in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if turn:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "headline queries, total seconds", "value": total, "unit": "sec", "queries": times, "sf": folder}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
