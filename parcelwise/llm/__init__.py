"""Training-data operators: language id, joins and dedup, quality, chat, packing, scoring, archives, mixing.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
