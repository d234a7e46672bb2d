"""Spark-native top-N recommendation analytics.

Entry points:
  tastebud.sources      scan_log, latest_snapshot, read_results, bindings
  tastebud.operators    cleansing, timewin, behavior, rules, ratings, cosine,
                        segments, factors, evaluate, compare, topn
  tastebud.plans        run_rules, run_cosine, run_given_segments, run_clusters,
                        run_als, run_compare (each returns named products)
  tastebud.sinks        write_product(s), write_partitioned and format writers
  tastebud.streaming    incremental implicit preference sums
  tastebud.registry     the registered queries and their DuckDB SQL twins
"""
