"""Training-data operators: packing, media, quality, toxicity, near copies, chat, mixing, PII, repeats.

Nothing else in the package imports this subpackage.
"""
