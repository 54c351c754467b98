"""Training-data operators: quality rules, secret and personal-data scans, near
duplicates, WARC archives, source mixing, nearest neighbours, SentencePiece
coding and sharding. One module per operator; ``queries`` registers them.

Every operator selects the columns it names and returns the key column plus its
own result columns, so extra columns of the input (clashing names included) are
never carried through. A null key is kept as a value of its own.
"""
