"""Training-data operators: mixing, extraction, near-duplicates, token counts,
decontamination, toxicity, language, line and exact deduplication, archives.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries for the driver.
"""
