"""Operators of a training-data pipeline, one module each.

``mixing``, ``sharding``, ``langid``, ``toxicity``, ``jaccard``, ``bpe``, ``fingerprint``,
``quotes``, ``ann`` and ``recurrent`` hold the operators, ``components`` and ``words`` what
several of them need, ``queries`` their registered queries.
"""
