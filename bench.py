"""Times the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line.

Each query runs to its last row (noop sink). The first query warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textspark.catalog import QUERIES, load_all  # noqa: E402
from textspark.session import local_session  # noqa: E402

HEADLINE = [
    "top_tfidf_terms",
    "word_count",
    "doc_freq",
    "sentences",
    "keyword_replace",
    "regex_replace",
    "word_ngrams",
    "char_ngrams",
    "tfidf",
    "tfidf_l2",
    "vocab_fit",
    "phrase_learn",
    "phrase_apply",
    "phrase_bow",
    "doc_vectors",
    "most_similar",
    "cosine_sparse",
    "label_terms",
    "contrast_terms",
    "strat_split",
    "naive_bayes",
    "logreg_fit",
    "pipeline_fit",
    "page_posts",
    "stream_ingest",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    load_all()
    run = lambda name: QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    run("word_tokens")
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else directory,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
