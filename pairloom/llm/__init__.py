"""Training-data operators: token output, licence scans, toxicity, packing,
near-duplicates, substring dedup, WARC archives, chat formatting and
benchmark decontamination.

Nothing else in the library imports this subpackage.  ``queries.py`` holds
the registered ``opN_<name>`` queries and their SQL; each operator lives in
a module of its own with a general interface.
"""
