"""Operators of the panel pipeline.  Each takes and returns Spark DataFrames.

Modules: validate (V*), panel (P*, W*, A1-A6, A9-A11, A13, J3), splits (C*),
preprocess (A12, T1), gram (L0), linear (L*), pca (D*), cluster (A7, A8, K*),
trees (R*), evaluate (M*, P8-P11, J1, J2, J4-J6, O*, U2).
"""
