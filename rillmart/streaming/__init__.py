"""Streaming faces: stateful operators and the running of queries.

Windows, joins and stateless plans are the batch operators applied to streams; only
histories of one visitor or user need state of their own, in ``stateful``.
"""
