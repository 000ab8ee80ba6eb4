"""Operators for preparing language-model training data, each independent of the rest of the library.

toxicity (classifier chain), decontamination (q-gram counting and banded alignment), token_counts (rank-synchronous BPE),
sharding (sampled splitters), tool_calls (linking, ordering, validation), mixing (Sainte-Lague apportionment),
jaccard_join (signature trees), quality_rules (ledger and policies), span_dedup (enhanced suffix arrays), quality_gam
(additive model with interactions). Their queries over whole tables are in ``queries``.
"""
