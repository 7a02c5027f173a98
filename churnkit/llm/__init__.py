"""Operators for preparing training text at scale (packing, duplicate
removal, classifiers, tokenising, chat rendering), one module each; the
registered queries are in :mod:`churnkit.llm.queries`."""
