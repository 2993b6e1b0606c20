"""Training-data operators: cleaning, dedup, decontamination, packing, search.

Nothing else in the package imports from here.  Every operator is a function
``DataFrame -> DataFrame``; ``queries`` registers one driver query for each.
"""
