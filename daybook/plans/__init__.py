"""The daily jobs, put together from the operators.

Each plan has a lazy form that returns frames, and a ``run_`` form that writes them for one date and can be rerun.
"""
