"""martflow.functions"""
