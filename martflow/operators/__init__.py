"""martflow.operators"""
