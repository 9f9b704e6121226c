"""Publisher formats: raw documents in, one row of raw fields per article out.

Each module has ``parse(documents)``, a select over many documents.  Rows that
cannot be parsed keep their payload and carry an ``error``.
"""
