"""Plan building blocks for order-dependent work.

A window partitioned by player or session puts every row of that key into
one task. With one player holding a third of all rows that task is the
whole job. The helpers in :mod:`playtrail.plans.ordered` split each key
into ordered buckets (time or position ranges), do the order-dependent part
inside the buckets, and carry what crosses a bucket edge through a small
per-(key, bucket) summary. The big table is shuffled once, on
(key, bucket); only the summaries are windowed per key.
"""
