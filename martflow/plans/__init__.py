"""martflow.plans"""
