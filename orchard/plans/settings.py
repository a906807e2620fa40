"""Default settings and tuning lists of the seven workflows, stated once."""

# naive Bayes
NB_LAMBDA = 5.0
NB_LAMBDAS = [1.0, 3.0, 5.0, 15.0, 25.0]

# logistic SGD
LOGISTIC_DEFAULT = dict(num_iterations=5, step_size=50.0, mini_batch_fraction=0.5)
LOGISTIC_SWEEP_FIXED = dict(num_iterations=100, step_size=100.0, mini_batch_fraction=1.0)
LOGISTIC_SWEEPS = [("num_iterations", [5, 15, 20, 60, 100]),
                   ("step_size", [10.0, 50.0, 100.0, 200.0]),
                   ("mini_batch_fraction", [0.5, 0.8, 1.0])]
LOGISTIC_GRID = [("num_iterations", [1, 3, 5, 10]), ("step_size", [10.0, 50.0, 100.0]),
                 ("mini_batch_fraction", [0.5, 0.8, 1.0])]

# SVM SGD (SVM_HISTORIC diverges: see linear.fit_svm_sgd; SVM_DEFAULT is the library's own)
SVM_HISTORIC = dict(num_iterations=25, step_size=50.0, reg_param=1.0)
SVM_DEFAULT = dict(num_iterations=25, step_size=1.0, reg_param=0.01)
SVM_SWEEP_FIXED = dict(num_iterations=25, step_size=100.0, reg_param=1.0)
SVM_SWEEPS = [("num_iterations", [1, 3, 5, 15, 25]),
              ("step_size", [10.0, 50.0, 100.0, 200.0]),
              ("reg_param", [0.01, 0.1, 1.0])]
SVM_GRID = [("num_iterations", [1, 3, 5, 15, 25]), ("step_size", [10.0, 50.0, 100.0, 200.0]),
            ("reg_param", [0.01, 0.1, 1.0])]

# trees
TREE_BINARY = dict(impurity="entropy", max_depth=5, max_bins=5)
TREE_MULTI = dict(impurity="entropy", max_depth=20, max_bins=100)
TREE_REGRESSION = dict(impurity="variance", max_depth=10, max_bins=50)
TREE_SWEEP_FIXED = dict(impurity="gini", max_depth=10, max_bins=10)
TREE_SWEEPS = [("impurity", ["gini", "entropy"]),
               ("max_depth", [3, 5, 10, 15, 20, 25]),
               ("max_bins", [3, 5, 10, 50, 100, 200])]
TREE_GRID = [("impurity", ["gini", "entropy"]), ("max_depth", [3, 5, 10, 15, 20]),
             ("max_bins", [3, 5, 10, 50, 100])]
# the part of the grid whose best tree is refitted as a key of its own
TREE_REFIT_GRID = [("impurity", ["gini", "entropy"]), ("max_depth", [3, 5]), ("max_bins", [5])]
TREE_REG_SWEEP_FIXED = dict(impurity="variance", max_depth=10, max_bins=10)
TREE_REG_SWEEPS = [("max_depth", [3, 5, 10, 15, 20, 25]), ("max_bins", [3, 5, 10, 50, 100, 200])]
TREE_REG_GRID = [("impurity", ["variance"]), ("max_depth", [3, 5, 10, 15, 20]),
                 ("max_bins", [3, 5, 10, 50, 100])]

# recommender
ALS_PARAMS = dict(rank=5, max_iter=20, reg_param=0.1)
TOP_N = 10
