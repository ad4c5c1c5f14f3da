"""martflow.workload"""
